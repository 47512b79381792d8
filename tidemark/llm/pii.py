"""Personal data: patterns, and terms that give protected entities away.

Patterns find emails, addresses, cards and phone numbers; each distinct value is a protected entity. A term that stands in
the documents of an entity may disclose it too: over the whole corpus, the pointwise mutual information of term and entity is set
against the information of the entity itself, -log2 p(entity). A term whose share of it reaches 1 / ALPHA is sanitised wherever it
stands in documents of that entity. Documents without an entity keep their text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, stored, table

KINDS = ["email", "ip", "card", "phone", "term"]
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its start fails from inside too, so only starts of runs are tried.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TERM = re.compile(r"\w{2,}")
DIGIT = re.compile(r"[0-9]")

ALPHA = 1.1  # the share of an entity's information that a term must disclose is 1 / ALPHA
MIN_TEXTS = 3  # different texts in which term and entity stand together
HELD_TERMS = 200_000  # distinct terms a task counts before it passes the counts on


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Places of addresses, in time linear in the text: from each @, the part before reaches back to the last match at most."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, sorted. A match that fails its kind's rule is dropped, without a retry."""
    found = []
    if "@" in text:
        found += [(start, 0, end) for start, end in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(DIGIT.findall(m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
        found.sort()
    return found


def signed(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def terms(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(term, start, end) of every word of a text that is not part of an entity; spans are sorted by their start."""
    at, reached = 0, 0
    for m in TERM.finditer(text):
        s, e = m.span()
        while at < len(spans) and spans[at][0] < e:
            reached = max(reached, spans[at][2])
            at += 1
        if s >= reached:
            yield signed(m.group().lower()), s, e


SURVEY = pa.schema([
    ("h1", pa.int64()), ("h2", pa.int64()),
    ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))),
    ("entities", pa.list_(pa.int64())), ("words", pa.list_(pa.int64())), ("term", pa.int64()), ("texts", pa.int64()),
])
SURVEY_SQL = (
    "h1 long, h2 long, base array<struct<start:int,kind:int,end:int>>, "
    "entities array<long>, words array<long>, term long, texts long"
)


def text_key() -> list[Column]:
    """Two seeded hashes of a text: rows of equal text have equal spans, so the text is its own key."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(17), text).alias("h2")]


def survey(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One pass over all texts: a row per document with its base spans, its entities and (if it has any) its terms, and rows (term, texts) of term counts."""

    def counts(held: Counter, idle: list[pa.Field]) -> pa.RecordBatch:
        n = len(held)
        empty = [pa.nulls(n, f.type) for f in [*idle, *list(SURVEY)[:5]]]
        terms = pa.array([signed(t) for t in held], pa.int64())
        return pa.RecordBatch.from_arrays(
            [*empty, terms, pa.array(list(held.values()), pa.int64())], [*[f.name for f in idle], *SURVEY.names])

    def surveyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        kept: list[pa.Field] = []
        for batch in batches:
            kept = [batch.schema.field(i) for i in range(len(keep))]
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = []
                for text in part.column(len(keep)).to_pylist():
                    text = text or ""
                    spans = base_spans(text)
                    rows.append({
                        "base": [{"start": s, "kind": k, "end": e} for s, k, e in spans],
                        "entities": list({signed(f"{k}:{text[s:e].lower()}") for s, k, e in spans}),
                        "words": list({t for t, _, _ in terms(text, spans)}) if spans else [],
                    })
                    held.update({t.lower() for t in set(TERM.findall(text))})
                made = pa.Table.from_pylist(rows, pa.schema(list(SURVEY)[2:5])).combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], part.column(len(keep) + 1), part.column(len(keep) + 2), *made.columns,
                     pa.nulls(part.num_rows, pa.int64()), pa.nulls(part.num_rows, pa.int64())],
                    [*keep, *SURVEY.names])
                if len(held) > HELD_TERMS:
                    yield counts(held, kept)
                    held.clear()
        if held:
            yield counts(held, kept)

    schema = "".join(f"`{c}` {t}, " for c, t in docs.select(*keep).dtypes) + SURVEY_SQL
    source = docs.select(*[F.col(c).alias(c) for c in keep], F.col("text").alias("_text"), *text_key())
    return stored(source.mapInArrow(surveyed, schema), "pii_survey")


def disclosing(seen: DataFrame, alpha: float = ALPHA, min_texts: int = MIN_TEXTS) -> DataFrame:
    """(h1, h2, told) of the texts that hold terms to be sanitised: told is their array.

    PMI(c, t) = log2(n(c, t) N / (n(c) n(t))) is compared with log2(N / n(c)) / alpha; n counts whole documents. Copies of a text
    are one text for ``min_texts``, so that copying alone makes nothing disclosing. An entity of fewer texts has no pair of so many,
    so pairs are made of the others only.
    """
    rows = seen.filter("h1 is not null")
    whole = rows.agg(F.count("*").alias("n"))
    texts = rows.filter(F.size("entities") > 0).groupBy("h1", "h2").agg(
        F.count("*").alias("times"), F.first("entities").alias("entities"), F.first("words").alias("words"))
    texts = stored(texts, "pii_texts")
    entities = stored(
        texts.select(F.explode("entities").alias("c"), "times").groupBy("c").agg(F.sum("times").alias("n_c"), F.count("*").alias("texts"))
        .filter(F.col("texts") >= min_texts).drop("texts"), "pii_entities")
    of = stored(texts.select("h1", "h2", F.explode("entities").alias("c")).join(entities, "c", "left_semi"), "pii_of")
    pairs = (
        of.join(texts.select("h1", "h2", "times", "words"), ["h1", "h2"]).select("c", F.explode("words").alias("t"), "times")
        .groupBy("c", "t").agg(F.sum("times").alias("n_ct"), F.count("*").alias("texts")).filter(F.col("texts") >= min_texts)
    )
    counts = seen.filter("term is not null").groupBy(F.col("term").alias("t")).agg(F.sum("texts").alias("n_t"))
    total = F.lit(float(whole.first()["n"]))
    told = F.log2(F.col("n_ct") * total / (F.col("n_c") * F.col("n_t"))) >= F.log2(total / F.col("n_c")) / alpha
    flagged = stored(pairs.join(entities, "c").join(counts, "t").filter(told).select("c", "t"), "pii_flagged")
    # Flagged pairs of an entity meet its texts; each text keeps those of its own terms.
    own = texts.select("h1", "h2", F.explode("words").alias("t"))
    asked = of.join(flagged.select("c").distinct(), "c", "left_semi").select("h1", "h2").distinct()
    held = own.join(asked, ["h1", "h2"], "left_semi").join(of, ["h1", "h2"])
    return held.join(flagged, ["c", "t"], "left_semi").groupBy("h1", "h2").agg(F.collect_set("t").alias("told"))


SPANS = "array<struct<start:int,kind:int,end:int>>"


def told_spans(text: str, told: list[int]) -> list[tuple[int, int, int]]:
    """Places of all occurrences of disclosing terms."""
    held = set(told)
    return [(s, 4, e) for t, s, e in terms(text, base_spans(text)) if t in held]


def term_spans(docs: DataFrame, added: DataFrame) -> DataFrame:
    """(h1, h2, terms): the places of disclosing terms in each text that has any, once per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [
                [{"start": s, "kind": k, "end": e} for s, k, e in told_spans(t or "", told)]
                for t, told in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kind)], ["h1", "h2", "terms"])

    keyed = docs.select(*text_key(), "text").join(added, ["h1", "h2"]).select("h1", "h2", "text", "told")
    return keyed.mapInArrow(run, f"h1 long, h2 long, terms {SPANS}").dropDuplicates(["h1", "h2"])


def find_private(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document: columns ``keep``, base and all spans as arrays of (start, kind, end), kinds as numbered in KINDS.

    Places are code points, the end is exclusive. A null text is empty; equal rows give equal results; an empty table gives none. Long texts are
    searched whole. Spans that begin together are ordered by kind. Columns of ``docs`` but ``keep`` and text are not read; ``base`` and ``spans`` among ``keep`` would clash.
    """
    seen = survey(docs, keep)
    added = stored(term_spans(docs, stored(disclosing(seen), "pii_told")), "pii_terms")
    return (
        seen.filter("h1 is not null").join(added, ["h1", "h2"], "left")
        .withColumn("spans", F.array_sort(F.concat("base", F.coalesce("terms", F.expr(f"cast(array() as {SPANS})")))))
        .select(*keep, "base", "spans")
    )


def sanitised(text: str, terms: list[tuple[int, int, int]]) -> str:
    """Base spans become their kind's mark. Terms are generalised to [NAME] or [NUMBER] by their look, or else removed."""
    out, at = [], 0
    for start, kind, end in sorted(base_spans(text) + terms, key=lambda s: (s[0], s[1])):
        if end <= at:
            continue
        if start >= at:
            out.append(text[at:start])
            word = text[start:end]
            if kind < 4:
                out.append(f"[{KINDS[kind].upper()}]")
            elif DIGIT.search(word):
                out.append("[NUMBER]")
            elif word[:1].isupper():
                out.append("[NAME]")
        at = end
    out.append(text[at:])
    return "".join(out)


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with private spans replaced in ``text``; other columns and rows stay. Null texts stay null."""
    names = docs.columns
    added = stored(disclosing(survey(docs, [])), "pii_told")
    at = names.index("text")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                new = [
                    None if t is None else sanitised(t, told_spans(t, extra) if extra else [])
                    for t, extra in zip(part.column(at).to_pylist(), part.column(len(names)).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new, pa.string()) if j == at else part.column(j) for j in range(len(names))], names)

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    keyed = docs.select("*", *[c.alias(f"_{n}") for c, n in zip(text_key(), ("h1", "h2"))])
    joined = keyed.join(added.withColumnsRenamed({"h1": "_h1", "h2": "_h2", "told": "_told"}), ["_h1", "_h2"], "left")
    return joined.select(*names, "_told").mapInArrow(cleaned, schema)


def joined(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"], s["end"])), ",")


@query("op7_pii")
def private(spark, sf_dir):
    """Private spans of every document."""
    found = find_private(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(4)]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
