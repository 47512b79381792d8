"""Importance resampling towards a target corpus, with feature counts by lines.

Features are runs of 1 to n consecutive words, hashed to buckets. A line end is a separator, so a text's runs are those of its lines plus the runs that
cross line ends. Equal lines, of any documents, are one row with a count: the features of a line are counted once and multiplied by it. Runs across
lines depend on neighbours and are counted per document. A bucket's gain is its log ratio of target to corpus; a document's weight is the sum of
its features' gains, and documents are drawn by weight plus Gumbel noise from a hash of the id.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, query, stored, table

BUCKETS, RUN, LEAST_WORDS, PERCENT, SEED = 10000, 1, 20, 10, 2024
HELD = 1 << 18  # words whose bucket a task remembers

# A-Z become a-z; 0-9, a-z and all bytes of characters beyond ASCII are kept, all else separates.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
LINE = bytes(10 if b == 10 else FOLD[b] for b in range(256))


class Features:
    """Buckets of words and of runs of words."""

    def __init__(self, buckets: int = BUCKETS, run: int = RUN):
        self.buckets, self.run, self.known = buckets, run, {}

    def words(self, found: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > HELD:
            known.clear()
        for w in set(found).difference(known):
            known[w] = zlib.crc32(w) % self.buckets
        return np.fromiter(map(known.__getitem__, found), np.int32, len(found))

    def runs(self, found: list[bytes], firsts: range | list[int], k: int) -> np.ndarray:
        return np.array([zlib.crc32(b" ".join(found[i : i + k])) % self.buckets for i in firsts], np.int32)

    def whole(self, found: list[bytes]) -> np.ndarray:
        """All runs of a sequence of words."""
        return np.concatenate([self.words(found), *[self.runs(found, range(len(found) - k + 1), k) for k in range(2, self.run + 1)]])

    def across(self, lines: list[list[bytes]]) -> np.ndarray:
        """The runs of a text that do not lie within a line, each once: at the first line end that it crosses."""
        lines = [line for line in lines if line]
        found = [w for line in lines for w in line]
        out, start = [np.zeros(0, np.int32)], 0
        for line in lines[:-1]:
            end = start + len(line)
            out += [self.runs(found, [i for i in range(max(start, end - k + 1), end) if i + k <= len(found)], k) for k in range(2, self.run + 1)]
            start = end
        return np.concatenate(out)


def totals(sums: np.ndarray) -> pa.RecordBatch:
    own = np.flatnonzero(sums)
    return pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own])], ["bucket", "n"])


def feature_counts(texts: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> np.ndarray:
    """Features per bucket of all ``texts`` (column text; null has none), as an array of ``buckets`` numbers.

    Lines are grouped first, so a line that a third of the corpus repeats is one row; what a task adds up is one number per bucket.
    """

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, sums = Features(buckets, run), np.zeros(buckets, np.int64)
        for batch in batches:
            for line, n in zip(batch.column(0), batch.column(1).to_pylist()):
                found = line.as_buffer().to_pybytes().translate(FOLD).split()
                if found:
                    np.add.at(sums, features.whole(found), n)
        yield totals(sums)

    def of_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, sums = Features(buckets, run), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    np.add.at(sums, features.across([line.split() for line in text.as_buffer().to_pybytes().translate(LINE).split(b"\n")]), 1)
        yield totals(sums)

    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''").groupBy("line").agg(F.count("*").alias("n"))
    parts = lines.select(F.col("line").cast("binary").alias("line"), "n").mapInArrow(of_lines, "bucket long, n long")
    if run > 1:
        parts = parts.unionByName(texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(of_ends, "bucket long, n long"))
    counts = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row per bucket
        counts[r["bucket"]] = r["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ((t + 1) (S + B) / ((s + 1) (T + B)))) of every bucket."""
    whole, wanted, size = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([
        math.floor(1000 * math.log((t + 1) * (whole + size) / ((s + 1) * (wanted + size)))) for s, t in zip(corpus.tolist(), target.tolist())
    ], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, run: int = RUN) -> DataFrame:
    """doc_id, words, n_features and weight of every whole text."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(len(gain), run)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = text.as_buffer().to_pybytes().translate(FOLD).split() if text.is_valid else []
                own = features.whole(found)
                rows.append((len(found), len(own), int(gain[own].sum())))
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], ["doc_id", "words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        weigh, "doc_id long, words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, run: int = RUN, seed: int = SEED
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    ``docs`` (doc_id, text) and ``target`` (text) are counted whole. Of the N documents with at least ``least_words`` words, the floor(percent * N / 100)
    with the highest scores are drawn and ranked from 1; ties go to the smaller doc_id, a null id last. The rank of all others is null.
    A null or empty text has no features and weight 0; a null id is hashed as the empty text. Repeated rows are documents of their own, with neighbouring ranks. An empty
    corpus has no rows, an empty target leaves the corpus's counts alone. Other columns are not read. A text, and a line, is one value in one task.
    """
    gain = gains(feature_counts(docs, buckets, run), feature_counts(target, buckets, run))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = stored(weighed(docs, gain, run).withColumn("score", F.col("weight") + noise), "scored")
    able = scored.filter(F.col("words") >= least_words)
    drawn = able.count() * percent // 100
    ranked = numbered(able, "rank", [F.desc("score"), F.asc_nulls_last("doc_id")])
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.filter(F.col("words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), aims AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
), said AS (
  SELECT r, unnest(w) AS w FROM docs
), crc_table(k, i, v) AS (
  SELECT 0, i, i::BIGINT FROM range(256) t(i)
  UNION ALL SELECT k + 1, i, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM crc_table WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM crc_table WHERE k = 8
), known AS (
  SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(w)), lambda i: ('0x' || substr(hex(encode(w)), (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket
  FROM (SELECT w FROM said UNION SELECT w FROM aims) CROSS JOIN crc
), corpus AS (
  SELECT bucket, count(*) AS s FROM said JOIN known USING (w) GROUP BY bucket
), goal AS (
  SELECT bucket, count(*) AS t FROM aims JOIN known USING (w) GROUP BY bucket
), sums AS (
  SELECT (SELECT coalesce(sum(s), 0) FROM corpus)::DOUBLE AS all_s, (SELECT coalesce(sum(t), 0) FROM goal)::DOUBLE AS all_t
), gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000) / ((coalesce(s, 0) + 1) * (all_t + 10000))))::BIGINT AS g
  FROM corpus FULL JOIN goal USING (bucket) CROSS JOIN sums
), weights AS (
  SELECT r, sum(g)::BIGINT AS weight FROM said JOIN known USING (w) JOIN gain USING (bucket) GROUP BY r
), scored AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (r)
), ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""


@query("op12_resample", SQL)
def op12_resample(spark, sf_dir):
    """Every document's features, weight, score, and rank if drawn towards the benchmark's distribution."""
    return resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))
