"""Interaction audit of quality filters over a sparse document-term matrix.

Texts are tokenised in blocks of some megabytes; a block numbers its own words and is stored as compressed sparse rows: row starts, local word numbers and
counts. The words of all blocks meet, sorted, and are numbered: that is the global dictionary, in which a block's word is looked up once, not once per occurrence.
With global word numbers, in sorted rows without repeats, a block is a shard of the matrix. A row's sum is the document's words, its number of entries
the different words. The other filters' verdicts are attached, and documents are counted by the set of filters they fail; everything an
order of filters does follows from those at most 32 counts per part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, query, stored, table

LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 200, 50, 2, b"#$%&*|"
BLOCK_BYTES, BLOCK_DOCS = 16 << 20, 1 << 16  # a block ends with the text that reaches either
LETTERS = "ABCDE"
BITS = {f: 1 << i for i, f in enumerate(LETTERS)}
ORDERS = ["".join(p) for p in permutations(LETTERS)]

UPPER = bytes(range(65, 91))
INNER = bytes(range(0x80, 0xC0))  # bytes that continue a character

GATHERED = 1 << 20  # looked-up words that a task holds before it sorts them by block
UNPACKED = 1 << 17  # entries of a block that are unpacked at once; a row is never cut

ROWS = "doc_id array<long>, source array<string>, key array<binary>, upper array<long>, points array<long>, symbol array<boolean>"
SHARD = f"block long, {ROWS}, starts array<int>, places binary, counts binary"


def planes(values: np.ndarray) -> bytes:
    """Small numbers byte by byte, all lowest bytes first, so that the zeros of the high bytes compress."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: pa.Buffer, start: int, end: int) -> np.ndarray:
    """The numbers from ``start`` to ``end``; the others stay packed."""
    return np.frombuffer(raw, np.uint8).reshape(4, -1)[:, start:end].T.copy().view("<u4").ravel()


class Block:
    """Documents with their words as compressed sparse rows over the block's own word numbers; a row's numbers rise, and their differences are kept."""

    def __init__(self):
        self.book: defaultdict[bytes, int] = defaultdict()
        self.book.default_factory = self.book.__len__
        self.rows: list[tuple] = []
        self.starts, self.places, self.counts, self.size = [0], [], [], 0

    def add(self, doc_id: int | None, source: str | None, key: bytes, text: bytes) -> None:
        found = text.split()  # cuts at x20 and x09 to x0D
        place, count = np.unique(np.fromiter(map(self.book.__getitem__, found), np.int32, len(found)), return_counts=True)
        self.places.append(np.diff(place, prepend=0))
        self.counts.append(count.astype(np.int32))
        self.starts.append(self.starts[-1] + len(place))
        upper, points = (len(text) - len(text.translate(None, own)) for own in (UPPER, INNER))
        symbol = len(text.translate(None, SYMBOLS)) < len(text)
        self.rows.append((doc_id, source, key, upper, len(text) - points, symbol))
        self.size += len(text)

    def batch(self, number: int) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
        columns = [pa.array([list(c)], pa.list_(k)) for c, k in zip(zip(*self.rows), kinds)]
        starts = pa.array([np.array(self.starts, np.int32)], pa.list_(pa.int32()))
        packed = [pa.array([planes(np.concatenate(x))], pa.binary()) for x in (self.places, self.counts)]
        terms = pa.array([list(self.book)], pa.list_(pa.binary()))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *columns, starts, *packed, terms],
            ["block", "doc_id", "source", "key", "upper", "points", "symbol", "starts", "places", "counts", "terms"])


def blocks(docs: DataFrame) -> DataFrame:
    """Blocks of all ``docs`` (doc_id, source, text), with the terms of each block by local number. A text is never cut; one above BLOCK_BYTES fills a block."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, Block()
        for batch in batches:
            for doc_id, source, key, text in zip(*(batch.column(i) for i in range(4))):
                block.add(doc_id.as_py(), source.as_py(), key.as_py(), text.as_buffer().to_pybytes())
                if block.size >= BLOCK_BYTES or len(block.rows) == BLOCK_DOCS:
                    done = block.batch(number)
                    number, block = number + 1, Block()  # the words of the last block are let go before it is sent
                    yield done
                    del done
        if block.rows:
            yield block.batch(number)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.unhex(F.sha2(text, 256)).alias("key"), text.cast("binary").alias("text"))
    return stored(rows.mapInArrow(made, f"{SHARD}, terms array<binary>"), "blocks")


def looked_up(terms: DataFrame) -> DataFrame:
    """(block, places, ids): the global numbers of words. ``terms`` (block, place, term), a word's rows together and sorted; nothing is gathered but numbers."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last, held, size = TaskContext.get().partitionId() << 40, None, [], 0

        def by_block() -> pa.RecordBatch:
            block, place, number = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(block, kind="stable")
            names, starts = np.unique(block[order], return_index=True)
            ends = pa.array(np.append(starts, len(block)).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [pa.array(names), *[pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (place, number)]], ["block", "places", "ids"])

        for batch in batches:
            if batch.num_rows:
                term = batch.column(2)
                new = np.concatenate(([term[0].as_py() != last], pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)))
                number = at + np.cumsum(new)
                held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), number))
                at, last, size = int(number[-1]), term[len(term) - 1].as_py(), size + len(term)
                if size >= GATHERED:
                    yield by_block()
                    held, size = [], 0
        if held:
            yield by_block()

    return terms.repartition(partitions(terms.sparkSession), "term").sortWithinPartitions("term").mapInArrow(made, "block long, places array<int>, ids array<long>")


def numbered_blocks(made: DataFrame) -> DataFrame:
    """The blocks with ``ids``, the global numbers of their words in lists of (places, ids). Numbers are unique over all texts, not dense.

    A word is one row per block here, so one in every document is as many rows as there are blocks.
    """
    ids = looked_up(made.select("block", F.posexplode("terms").alias("place", "term")))
    return made.drop("terms").join(ids.groupBy("block").agg(F.collect_list(F.struct("places", "ids")).alias("ids")), "block", "left")


def canonical(starts: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by column, entries of one column added up."""
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((columns, row))
    row, columns, counts = row[order], columns[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (columns[1:] != columns[:-1])))) if len(row) else np.zeros(0, np.int64)
    summed = np.add.reduceat(counts.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    return np.concatenate(([0], np.cumsum(np.bincount(row[first], minlength=len(starts) - 1)))), columns[first], summed


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(batch, its row, documents of the block, and their part of the matrix). A block is taken apart in stretches of documents, so that its packed form is all that is held whole."""
    for batch in batches:
        for i in range(batch.num_rows):
            starts, numbers = batch.column("starts")[i].values.to_numpy(), global_numbers(batch.column("ids")[i])
            places, counts = (batch.column(n)[i].as_buffer() for n in ("places", "counts"))
            first = 0
            while first < len(starts) - 1:
                end = max(first + 1, int(np.searchsorted(starts, starts[first] + UNPACKED, "right")) - 1)
                own = starts[first : end + 1] - starts[first]
                columns = np.cumsum(from_planes(places, starts[first], starts[end]), dtype=np.int64)
                # A row's differences begin with its first number: take off what the rows before it add up to.
                before = np.concatenate(([0], columns))[own[:-1]]
                columns -= np.repeat(before, np.diff(own))
                yield batch, i, slice(first, end), *canonical(own, numbers[columns], from_planes(counts, starts[first], starts[end]))
                first = end


def global_numbers(found: pa.Scalar) -> np.ndarray:
    """The global number of each local word, from (places, ids) in any order."""
    if found.values is None or not len(found.values):
        return np.zeros(0, np.int64)
    place, number = (found.values.field(n).flatten().to_numpy() for n in ("places", "ids"))
    out = np.zeros(len(place), np.int64)
    out[place] = number
    return out


def matrix(docs: DataFrame) -> DataFrame:
    """The document-term matrix: (block, doc_id array, starts, columns, counts); row r has the entries from starts[r] to starts[r + 1]. A block may be several such shards."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, own, starts, columns, counts in shards(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("block").slice(i, 1), *[pa.array([a], pa.list_(pa.int64())) for a in (batch.column("doc_id")[i].values[own], starts, columns, counts)]],
                ["block", "doc_id", "starts", "columns", "counts"])

    return numbered_blocks(blocks(docs)).mapInArrow(made, "block long, doc_id array<long>, starts array<long>, columns array<long>, counts array<long>")


def measures(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, key, words, distinct_words, upper, points, symbol."""
    one = ["doc_id", "source", "key", "upper", "points", "symbol"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, own, starts, _, counts in shards(batches):
            sums = np.concatenate(([0], np.cumsum(counts)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n)[i].values[own] for n in one], pa.array(np.diff(sums[starts])), pa.array(np.diff(starts))], [*one, "words", "distinct_words"])

    return numbered_blocks(blocks(docs)).mapInArrow(
        made, "doc_id long, source string, key binary, upper long, points long, symbol boolean, words long, distinct_words long")


def failures(docs: DataFrame, least_words: int = LEAST_WORDS, distinct_percent: int = DISTINCT_PERCENT, upper_percent: int = UPPER_PERCENT) -> DataFrame:
    """doc_id, source and ``failed``, the bits of the filters A to E that each document fails."""
    rows = stored(measures(docs), "measures")
    least = stored(rows.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1").select("key", "least"), "copies")

    def bit(failed: Column, letter: str) -> Column:
        return F.when(failed, BITS[letter]).otherwise(0)

    return rows.join(least, "key", "left").select("doc_id", "source", (
        bit(F.col("words") < least_words, "A") + bit(F.col("distinct_words") * 100 < F.col("words") * distinct_percent, "B")
        + bit(F.col("upper") * 100 > F.col("points") * upper_percent, "C") + bit(F.col("symbol"), "D") + bit(F.col("doc_id") > F.col("least"), "E")
    ).alias("failed"))


def audit(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """What each of the 120 orders of five filters does at each step, per source.

    ``docs`` (doc_id, text, source): whole texts, null is empty. A: fewer than ``least_words`` words; B: distinct words under ``distinct_percent`` of the words; C: A-Z over
    ``upper_percent`` of the code points; D: any of #$%&*|; E: the text of a smaller doc_id (a null id is neither smaller nor larger). ``labels`` (doc_id, quality, toxic): a
    document is good or toxic if any of its labels says 1. Repeated rows count each; equal ids with one text are not copies of each other. A null source
    is the part ''. No documents, no rows. Other columns are not read. A text is one value in one task.

    Columns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: see the counts below.
    """
    marked = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic"))
    counted = failures(docs, **limits).join(marked, "doc_id", "left").groupBy(F.coalesce("source", F.lit("")).alias("part"), "failed").agg(
        F.count("*").alias("n"), F.count("good").alias("good"), F.count("toxic").alias("toxic"))
    # A filter after a set of others: 80 cases, whatever the order within the set.
    cases = [(sum(BITS[g] for g in LETTERS if g in earlier), BITS[f]) for f in LETTERS for earlier in subsets(LETTERS.replace(f, ""))]
    spread = counted.withColumn("case", F.explode(F.array(*[F.struct(F.lit(a).alias("before"), F.lit(b).alias("own")) for a, b in cases]))).select("*", "case.*")
    fails = F.col("failed").bitwiseAND(F.col("own")) > 0
    gone = F.col("failed").bitwiseAND(F.col("before")) > 0
    share = F.col("n") * F.lit(len(ORDERS)) / F.bit_count("failed")  # a document falls to each filter it fails in equally many orders

    def added(value: Column, condition: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long")

    done = spread.groupBy("part", "before", "own").agg(
        added(F.col("n"), ~fails & ~gone).alias("kept"), added(F.col("n"), fails & ~gone).alias("removed"), added(F.col("n"), fails & gone).alias("redundant"),
        added(F.col("n"), F.col("failed") == F.col("own")).alias("unique_fails"), added(F.col("good"), fails & ~gone).alias("good_lost"),
        added(F.col("toxic"), fails & ~gone).alias("toxic_lost"), added(F.round(share).cast("long"), fails).alias("shapley"))
    steps = [(o, i + 1, sum(BITS[f] for f in o[:i]), BITS[o[i]]) for o in ORDERS for i in range(len(o))]
    fixed = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, own int")  # 600 rows
    return done.join(F.broadcast(fixed), ["before", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def subsets(letters: str) -> list[str]:
    return ["".join(f for i, f in enumerate(letters) if m >> i & 1) for m in range(1 << len(letters))]


SQL = r"""
WITH letter(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31
), docs AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), failing AS (
  SELECT part, doc_id, (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x) THEN 4 ELSE 0 END) + (CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END) AS m
  FROM docs
), marked AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), counted AS (
  SELECT part, m, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t FROM failing LEFT JOIN marked USING (doc_id) GROUP BY part, m
), steps AS (
  SELECT o, i, own.b AS own, coalesce((SELECT sum(l.b) FROM letter l WHERE strpos(left(o, (i - 1)::INT), l.f) > 0), 0)::INT AS before
  FROM orders CROSS JOIN range(1, 6) r(i) JOIN letter own ON own.f = substr(o, i::INT, 1)
), each_step AS (
  SELECT part, o, i, own,
         coalesce(sum(n) FILTER (m & (own | before) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (m & own > 0 AND m & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (m & own > 0 AND m & before > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (m = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(g) FILTER (m & own > 0 AND m & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(t) FILTER (m & own > 0 AND m & before = 0), 0)::BIGINT AS toxic_lost
  FROM counted CROSS JOIN steps GROUP BY part, o, i, own
)
SELECT part, o AS filter_order, i::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM each_step
"""


@query("op13_filter_audit", SQL)
def filter_audit(spark, sf_dir):
    """All documents under the five filters, per source, order and step."""
    return audit(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels"))
