"""Benchmark decontamination by the q-gram lemma.

A stretch of text within k edits of a benchmark item of m characters shares at least m - q + 1 - k q of its q-grams, all on
diagonals (place in the text less place in the item) that lie at most k apart. Shared q-grams are counted in overlapping bands
of diagonals, so that any k neighbouring ones lie in one band; bands that reach the bound are verified by an alignment of the whole
item within the band. An item of any length counts where the whole of it stands within its edit budget; one shorter than a q-gram has no budget and
must stand word for word. Texts and items are compared byte by byte in lower case (Unicode's, one character for one; ß as ss, final sigma
as sigma), with white space as blanks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, stored, table
from tidemark.llm.textbytes import SPACE, overlapping, utf8

GRAM = 14
EDITS, MOST_EDITS = 0.05, 409  # edit budget as a share of an item's length, up to so many edits, which 8 KB reach
BAND = 32  # least distance of an item's bands; with a larger budget that is the distance. A band is wider than it by the budget
FIRST = (64,)  # budgets tried first, about the diagonal of most shared q-grams, where an item's own is larger
CHUNK = 1 << 19
ITEM_BYTES = 2 << 20  # of items that one index holds (about 30 times as much in memory); more are searched round by round
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[SPACE] = 32
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SIEVE = 22  # bits, or more for many q-grams, of the table that most other q-grams fail at


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place: the first and the last eight of them."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint64)
    wide = data.astype(np.uint64)
    for k in (1, 2, 4):
        wide = wide[:-k] | wide[k:] << np.uint64(8 * k)
    out = wide[: len(data) - GRAM + 1] * FACTOR
    out ^= out >> np.uint64(31)
    out += wide[GRAM - 8 :]
    out *= FACTOR
    return out


def lower(column: pa.Array) -> pa.Array:
    """Texts in lower case; in one that is not valid UTF-8 only A-Z change."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    try:
        return pc.utf8_lower(column)
    except pa.ArrowInvalid:
        made = []
        for i in range(len(column)):
            try:
                made.append(pc.utf8_lower(column[i]).as_buffer().to_pybytes())
            except pa.ArrowInvalid:
                made.append(column[i].as_buffer().to_pybytes().lower())
        return pa.array(made, pa.large_binary()).view(pa.large_string())


def folded(raw: np.ndarray) -> np.ndarray:
    """Bytes of lower-case texts with the small letters alike that have one capital."""
    out = raw.copy()
    sharp = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] == 0x9F))
    out[sharp], out[sharp + 1] = 115, 115
    out[1:][(raw[:-1] == 0xCF) & (raw[1:] == 0x82)] = 0x83
    return out


def places(own: np.ndarray, low: np.ndarray, at: list[int]) -> list[int]:
    """Places in a text of those in its lower case, whose characters may have other lengths."""
    a, b = (np.append(np.flatnonzero(x & 0xC0 != 0x80), len(x)) for x in (own, low))
    if len(own) == len(low) and np.array_equal(a, b):
        return at
    n = np.maximum(np.searchsorted(b, at, "right") - 1, 0)
    return np.minimum(a[n] + np.array(at) - b[n], a[np.minimum(n + 1, len(a) - 1)]).tolist()


def budget(size: int) -> int:
    """Edits allowed: the share of the length, but so few that a match must share a q-gram, and no more than an alignment can follow in any length."""
    return max(0, min(int(size * EDITS), (size - GRAM) // GRAM, MOST_EDITS))


def in_words(data: np.ndarray) -> np.ndarray:
    """Whether each byte is part of a word: a letter, a digit, or of a character beyond ASCII."""
    return (data >= 128) | (data >= 97) & (data <= 122) | (data >= 65) & (data <= 90) | (data >= 48) & (data <= 57)


def aligned(own: np.ndarray, region: np.ndarray, edge: int, span: int, k: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best alignment of ``own`` with a stretch of ``region`` on the diagonals from ``edge`` on, ``span`` of them, within k edits."""
    width, big = len(region) + 1, len(own) + 1
    steps = np.arange(width)
    cost, origin = np.zeros(width, np.int64), steps.copy()
    for i, c in enumerate(own.tolist(), 1):
        # Columns of the band in this row; what lies outside is out of reach.
        a, b = max(0, edge + i), min(width, edge + i + span + 1)
        if a >= b:
            return None
        best, source = cost[a:b] + 1, origin[a:b].copy()
        skip = int(a == 0)  # the first column has nothing to its left
        left = slice(a + skip - 1, b - 1)
        diagonal = cost[left] + (region[left] != c)
        closer = diagonal <= best[skip:]
        best[skip:][closer], source[skip:][closer] = diagonal[closer], origin[left][closer]
        ahead = best - steps[a:b]
        slope = np.minimum.accumulate(ahead)
        taken = np.maximum.accumulate(np.where(ahead == slope, steps[: b - a], 0))
        cost[a:b], origin[a:b] = slope + steps[a:b], source[taken]
        if i == 1:
            cost[:a], cost[b:] = big, big
        elif a:
            cost[a - 1] = big
        if cost[a:b].min() > k:
            return None
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


def most_shared(own: np.ndarray, region: np.ndarray) -> int:
    """The median diagonal of q-grams that stand once in the item."""
    grams, place, count = np.unique(gram_hashes(own), return_index=True, return_counts=True)
    grams, place = grams[count == 1], place[count == 1]
    h = gram_hashes(region)
    slot = np.minimum(np.searchsorted(grams, h), max(0, len(grams) - 1))
    hit = np.flatnonzero(grams[slot] == h) if len(grams) else np.zeros(0, np.int64)
    return int(np.median(hit - place[slot[hit]])) if len(hit) else 0


class Index:
    """q-grams of the items of a round, and the items shorter than a q-gram by length."""

    def __init__(self, items: list[tuple[int, bytes]]) -> None:
        self.short: dict[int, dict[bytes, list[int]]] = {}
        for i, t in items:
            if len(t) < GRAM:
                self.short.setdefault(len(t), {}).setdefault(LOWER[np.frombuffer(t, np.uint8)].tobytes(), []).append(i)
        items = [(i, t) for i, t in items if len(t) >= GRAM]
        self.ids = [i for i, _ in items]
        self.texts = [LOWER[np.frombuffer(t, np.uint8)] for _, t in items]
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.array([budget(n) for n in self.sizes.tolist()], np.int64)
        self.apart = np.maximum(self.edits, BAND)  # distance of an item's bands
        self.needed = self.sizes - GRAM + 1 - self.edits * GRAM
        hashes = [gram_hashes(t) for t in self.texts]
        every = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(every, kind="stable")
        self.item = np.repeat(np.arange(len(items), dtype=np.int32), [len(h) for h in hashes])[order]
        self.place = np.concatenate([np.zeros(0, np.int32), *[np.arange(len(h), dtype=np.int32) for h in hashes]])[order]
        self.grams, start, count = np.unique(every[order], return_index=True, return_counts=True)
        self.start, self.count = start.astype(np.int32), count.astype(np.int32)
        self.reach = int((self.sizes + self.edits).max(initial=GRAM)) + 1  # a match lies within so many bytes
        self.sift()

    def sift(self) -> None:
        bits = max(SIEVE, len(self.grams).bit_length() + 3)
        self.sieve, self.shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
        self.sieve[(self.grams >> self.shift).astype(np.int64)] = True
        self.tables = {n: np.unique(self.short_hashes(np.frombuffer(b"".join(own), np.uint8), n)[::n]) for n, own in self.short.items()}

    @staticmethod
    def short_hashes(data: np.ndarray, n: int) -> np.ndarray:
        """A hash of the ``n`` bytes from each place."""
        out = np.zeros(max(0, len(data) - n + 1), np.uint64)
        for k in range(n):
            out = (out ^ data[k : len(data) - n + 1 + k]) * FACTOR
        return out

    def arrays(self) -> dict:
        """All there is to send: plain arrays, which a worker without this package can load."""
        return {k: v for k, v in vars(self).items() if k not in ("sieve", "shift", "tables")}

    @classmethod
    def of(cls, arrays: dict) -> Index:
        index = cls.__new__(cls)
        vars(index).update(arrays)
        index.sift()
        return index

    def word_for_word(self, data: np.ndarray, begins: np.ndarray, piece: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(piece, item id, start, end) of the items shorter than a q-gram, where no word goes on at either end. ``cuts``: whether a piece's text goes on before and after it."""
        word = in_words(data)
        for n, known in self.short.items():
            h = self.short_hashes(data, n)
            slot = np.minimum(np.searchsorted(self.tables[n], h), len(self.tables[n]) - 1)
            at = np.flatnonzero(self.tables[n][slot] == h)
            at = at[piece[at] == piece[at + n - 1]]
            before, after = np.maximum(at - 1, 0), np.minimum(at + n, len(data) - 1)
            runs_on = word[at] & word[before] & (at > 0) & (piece[before] == piece[at]) | word[at + n - 1] & word[after] & (at + n < len(data)) & (piece[after] == piece[at])
            # At a cut the neighbour is not seen here; the piece before or after holds the match with both its neighbours.
            cut = cuts[piece[at], 0] & (at == begins[piece[at]]) | cuts[piece[at], 1] & ((at + n == len(data)) | (piece[after] != piece[at]))
            for a in at[~runs_on & ~cut].tolist():
                p = int(piece[a])
                for item in known.get(data[a : a + n].tobytes(), ()):
                    yield p, item, a - int(begins[p]), a - int(begins[p]) + n

    def candidates(self, data: np.ndarray, begins: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """(piece, item, band) with enough shared q-grams."""
        if not len(self.grams):
            return np.zeros((0, 3), np.int64)
        h = gram_hashes(data)
        at = np.flatnonzero(self.sieve[(h >> self.shift).astype(np.int64)])
        at = at[piece[at] == piece[at + GRAM - 1]]
        slot = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        hit = self.grams[slot] == h[at]
        at, slot = at[hit], slot[hit]
        n = self.count[slot]
        at = np.repeat(at, n)
        post = np.repeat(self.start[slot] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        item = self.item[post]
        diagonal = at - begins[piece[at]] - self.place[post] + self.reach  # never negative
        # Band j of an item holds diagonals from j times the item's distance on, the distance and the item's budget of them.
        apart = self.apart[item]
        top = diagonal // apart
        keys = []
        for back in range(2):
            j = top - back
            ok = (j >= 0) & (diagonal < (j + 1) * apart + self.edits[item])
            keys.append(np.stack([piece[at][ok], item[ok], j[ok]]))
        rows = np.concatenate(keys, axis=1)
        if not rows.shape[1]:
            return np.zeros((0, 3), np.int64)
        code = (rows[0] * len(self.ids) + rows[1]) * (1 << 24) + rows[2]
        code, shared = np.unique(code, return_counts=True)
        item = code >> 24
        item = item % len(self.ids)
        code = code[shared >= self.needed[item]]
        return np.stack([(code >> 24) // len(self.ids), (code >> 24) % len(self.ids), code & ((1 << 24) - 1)], axis=1)

    def verify(self, text: np.ndarray, item: int, band: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best alignment of the whole item in the band, if within the budget."""
        own, k, apart = self.texts[item], int(self.edits[item]), int(self.apart[item])
        first = band * apart - self.reach - k
        low, high = max(0, first), min(len(text), first + 2 * k + apart + k + len(own))
        region = text[low:high]
        found = region.tobytes().find(own.tobytes())
        if found >= 0:
            return 0, low + found, low + found + len(own)
        best, edge = None, first - low
        for few in (f for f in FIRST if f < k):
            # A long item: an alignment near the diagonal of most shared q-grams decides too, though it may not be the best one.
            middle = most_shared(own, region)
            if best := aligned(own, region, middle - few, 2 * few, few):
                break
        best = best or aligned(own, region, edge, apart + 3 * k, k)
        return best and (best[0], low + best[1], low + best[2])

    def search(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item id, edits, start, end) in bytes of the row's text; an item may be found more than once."""
        for pieces in overlapping(offsets, max(CHUNK, 4 * self.reach), min([GRAM, *self.short])):
            yield from self._search(raw, offsets, pieces)

    def _search(self, raw, offsets, pieces):
        data = LOWER[np.concatenate([raw[max(int(offsets[r]), s - self.reach) : e] for r, s, e in pieces])]
        starts = [max(int(offsets[r]), s - self.reach) for r, s, _ in pieces]
        lengths = np.array([e - s for s, (_, _, e) in zip(starts, pieces)])
        begins = np.cumsum(lengths) - lengths
        piece = np.repeat(np.arange(len(pieces)), lengths)
        cuts = np.array([(s > offsets[r], e < offsets[r + 1]) for s, (r, _, e) in zip(starts, pieces)])
        for p, item, start, end in self.word_for_word(data, begins, piece, cuts):
            shift = starts[p] - int(offsets[pieces[p][0]])
            yield pieces[p][0], item, 0, start + shift, end + shift
        exact = None
        for p, item, band in self.candidates(data, begins, piece).tolist():
            if (p, item) == exact:  # bands rise, so no later one holds a better match or an earlier equal one
                continue
            found = self.verify(data[begins[p] : begins[p] + lengths[p]], item, band)
            if found:
                exact = exact if found[0] else (p, item)
                row, shift = pieces[p][0], starts[p] - int(offsets[pieces[p][0]])
                yield row, self.ids[item], found[0], found[1] + shift, found[2] + shift


def indexes(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[Index]:
    """Indexes of ITEM_BYTES of items at most, or of one longer item, each made when it is asked for.

    Null items and items of white space only take no part.
    """
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).cast("binary").alias("t")).filter("t is not null")
    held: list[tuple[int, bytes]] = []
    size = 0
    for r in rows.orderBy("i", "t").toLocalIterator():
        text = pa.array([bytes(r["t"])], pa.large_binary()).view(pa.large_string())
        t = folded(utf8(lower(text))[0]).tobytes()
        if not t.strip():
            continue
        if held and size + len(t) > ITEM_BYTES:
            yield Index(held)
            held, size = [], 0
        held.append((r["i"], t))
        size += len(t)
    if held:
        yield Index(held)


FOUND = "array<struct<item:long,edits:int,start:long,end:long>>"


def searched(docs: DataFrame, index: Index, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every document and ``found``, by the items of one round."""
    shared = docs.sparkSession.sparkContext.broadcast(index.arrays())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.of(shared.value)
        kind = pa.list_(pa.struct([("item", pa.int64()), ("edits", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            raw, offsets = utf8(batch.column(len(keep)))
            small, cuts = utf8(lower(batch.column(len(keep))))
            best: list[dict] = [{} for _ in range(batch.num_rows)]
            for row, item, edits, start, end in index.search(folded(small), cuts):
                start, end = places(raw[offsets[row] : offsets[row + 1]], small[cuts[row] : cuts[row + 1]], [start, end])
                known = best[row].get(item)
                if known is None or (edits, start) < known[:2]:
                    best[row][item] = (edits, start, end)
            found = [[{"item": i, "edits": e, "start": s, "end": t} for i, (e, s, t) in sorted(b.items())] for b in best]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found, kind)], [*keep, "_found"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    return docs.select(*[F.col(c).alias(c) for c in keep], F.col("text").alias("_text")).mapInArrow(run, f"{schema}, _found {FOUND}")


def rounds(docs: DataFrame, benchmark: DataFrame, search: Callable[[DataFrame, Index, bool], DataFrame]) -> DataFrame:
    """``search`` by each index on what the one before gave; it is told whether more follow.

    A usual benchmark is one index, and nothing is written. A larger one is never held whole: what an index gave goes to
    the shared folder before the next one is made.
    """
    last = None
    for index in indexes(benchmark):
        if last is not None:
            docs = stored(search(docs, last, True), "decontam_round")
        last = index
    return docs if last is None else search(docs, last, False)


def matches(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every document and ``found``: array of (item, edits, start, end), the best match of each item, in bytes.

    A null text is empty and holds nothing; repeated rows are judged alike; an empty benchmark finds nothing. Of equally good
    matches of an item the first in the text counts. Items with equal ids are one item. Texts and items may have any length; where an item allows more
    than 64 edits (over 1,280 bytes), those given are of an alignment within the budget, not always of the best one.
    """
    held = [f"_k{i}" for i in range(len(keep))]

    def search(df: DataFrame, index: Index, more: bool) -> DataFrame:
        got = searched(df, index, [c for c in df.columns if more or c != "text"])
        if "_all" not in df.columns:
            return got.withColumnRenamed("_found", "_all")
        # An item's id may stand in both indexes.
        both = got.withColumn("_all", F.concat("_all", "_found")).drop("_found")
        best = F.transform(
            F.array_distinct(F.transform("_all", lambda f: f["item"])), lambda i: F.array_min(F.filter("_all", lambda f: f["item"].eqNullSafe(i))))
        return both.withColumn("_all", best)

    out = rounds(docs.select(*[F.col(c).alias(h) for c, h in zip(keep, held)], "text"), benchmark, search)
    found = F.array_sort("_all") if "_all" in out.columns else F.expr(f"cast(array() as {FOUND})")
    return out.select(*[F.col(h).alias(c) for c, h in zip(keep, held)], found.alias("found"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns. Nothing is shuffled."""

    def clean(df: DataFrame, index: Index, more: bool) -> DataFrame:
        return searched(df, index, docs.columns).filter(F.size("_found") == 0).drop("_found")

    return rounds(docs, benchmark, clean)


@query("op3_decontaminate")
def decontamination(spark, sf_dir):
    """Benchmark items in every document."""
    found = matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", (F.size("found") > 0).alias("contaminated"), F.transform("found", lambda f: f["item"]).alias("item_ids"),
        F.array_join(F.transform("found", lambda f: F.concat_ws(":", f["item"], f["start"], f["end"], f["edits"])), ",").alias("spans"),
    )
