"""URL filters: a range join of urls with nested (host, path) rules by a sorted sweep.

A host becomes a canonical key by reversing its labels (``www.example.com`` -> ``com.example.www.``).
A rule's host and all subdomains are then one interval of keys, those that start with the rule's key,
and intervals of rules are nested or apart. Urls and rules are dealt to ranges of keys, sorted, and
swept once: a stack holds the rules whose interval is open, and the path is compared with these only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SAMPLE_PER_RANGE = 50  # keys looked at to place a range's border; results do not depend on it


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(raw) + 1, F.length(rest))
    known = F.instr(url, "://") > 0
    host = F.when(known, F.translate(raw, UPPER, LOWER))
    path = F.when(known, F.regexp_extract(tail, r"^[^?#]*", 0))
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each closed by a dot; empty for an empty host."""
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))
    return F.when(host == "", F.lit("")).otherwise(key)


class Sweep:
    """The stack of open rules along rising keys of one range."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, host: str, path: str, verdict: str) -> None:
        self.close(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, rules, lengths = self.stack[-1]
        if rules.get(path, ("", ""))[1] != "block":
            rules[path] = (host + path, verdict)
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def judge(self, key: str, path: str) -> tuple[str | None, str | None]:
        self.close(key)
        best: tuple[str, str] | None = None
        for _, rules, lengths in reversed(self.stack):  # longest host first
            for n in lengths:
                found = rules.get(path[:n]) if n <= len(path) else None
                if found:
                    if best is None or len(found[0]) > len(best[0]):
                        best = found
                    break
        return best or (None, None)


def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by range, key and kind (rules first); only the stack is kept."""
    at, now = None, Sweep()
    for batch in batches:
        rule, verdict = [], []
        for piece, key, is_url, host, path, said in zip(
            batch["piece"], batch["key"], batch["is_url"], batch["host"], batch["path"], batch["verdict"]
        ):
            if piece != at:
                at, now = piece, Sweep()
            if is_url:
                r, v = now.judge(key, path)
                rule.append(r)
                verdict.append(v)
            else:
                now.open(key, host, path, said)
        urls = batch[batch["is_url"]]
        yield pd.DataFrame({
            "id": urls["id"].array, "host": urls["host"].array, "path": urls["path"].array,
            "rule": pd.Series(rule, dtype=object), "verdict": pd.Series(verdict, dtype=object),
        })


def judge_urls(
    urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per url row: id, host, path, rule (host and path of the rule that decides, or null), verdict.

    ``rules``: host, path, verdict ('allow' or 'block'). A rule fits its host and all subdomains if the path
    starts with its path; the longest rule string wins, of equally long ones the one with the longer host. Of
    two rules with the same host and path, block wins. Rules with an empty or null host fit nothing; a null path
    is empty. Urls without a rule get ``default``. Null urls, nulls in the id and repeated rows stay, each with its own row.
    Other columns of ``urls`` are not read, so their names cannot clash. An empty table gives no rows; urls of any length are judged whole.
    """
    spark = urls.sparkSession
    ranges = partitions(spark)
    id_type = dict(urls.dtypes)[id_col]
    host, path = url_parts(F.col(url_col))
    keyed = (
        urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(url_col).alias("url"))
        .withColumn("key", host_key(F.col("host")))
    )
    # Borders of ranges come from a bounded sample. A key that fills several ranges is dealt among them.
    sample = keyed.select("key").orderBy(F.xxhash64("id", "url")).limit(SAMPLE_PER_RANGE * ranges).toPandas()["key"]
    found = sorted(sample)
    borders = np.array(found[SAMPLE_PER_RANGE::SAMPLE_PER_RANGE], dtype=object)

    @F.pandas_udf("int")
    def first_piece(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, key.to_numpy(dtype=object), side="left"), dtype="int32")

    @F.pandas_udf("int")
    def last_piece(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, key.to_numpy(dtype=object), side="right"), dtype="int32")

    dealt = (
        keyed.withColumn("lo", first_piece("key")).withColumn("hi", last_piece("key"))
        .withColumn("spot", F.xxhash64(F.monotonically_increasing_id()))
        .select(
            (F.col("lo") + F.expr("cast(pmod(spot, hi - lo + 1) as int)")).alias("piece"), "key", F.lit(True).alias("is_url"),
            "id", "host", "path", F.lit(None).cast("string").alias("verdict"),
        )
    )
    # A rule goes to every range that its interval of keys meets.
    opened = (
        rules.select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict").filter("host <> ''")
        .withColumn("key", host_key(F.translate("host", UPPER, LOWER)))
        .withColumn("lo", first_piece("key"))
        .withColumn("hi", last_piece(F.concat("key", F.lit("\U0010ffff"))))
        .select(
            F.explode(F.expr("sequence(lo, hi)")).alias("piece"), "key", F.lit(False).alias("is_url"),
            F.lit(None).cast(id_type).alias("id"), "host", "path", "verdict",
        )
    )
    swept = (
        dealt.unionByName(opened).repartition(ranges, "piece").sortWithinPartitions("piece", "key", "is_url")
        .mapInPandas(sweep, f"id {id_type}, host string, path string, rule string, verdict string")
    )
    return swept.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]

SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts
), cut AS (
  SELECT page_id,
         coalesce(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path
  FROM hosts
), rules(rhost, rpath, said) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), numbered AS (SELECT *, row_number() OVER () AS n FROM cut),
fits AS (
  SELECT n, rhost || rpath AS rule, said,
         row_number() OVER (PARTITION BY n ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
  FROM numbered JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict
FROM numbered LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (n)
"""


@query("op1_url_filter", SQL)
def url_filter(spark, sf_dir):
    """Every page's url under five nested rules."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)
