"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint's bits are cut into blocks. In each block the words of a code are the anchors: the [15, 11] Hamming code, which
has a word within 1 of any 15 bits, next to bits taken as they are. A fingerprint has its home at its nearest anchor and is
copied to every anchor within the code's radius plus the block's threshold. If two fingerprints differ by no more than the
threshold in a block, the second has a copy at the first one's home. With thresholds t whose t + 1 add up to more than d, any
two fingerprints that differ by d bits meet in some block. Each anchor's homes are compared with its copies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, query, stored, table
from tidemark.llm.components import components

HOME_LIMIT = 4096  # homes of an anchor that one task holds; beyond it they are split and copies go to every part
PAIRS = 1 << 18  # comparisons made at once; where all are links, their arrays take 36 MB of a Python worker at most (275 MB with 2^21)


class Block(NamedTuple):
    """Bits of a fingerprint: which of its two 64-bit numbers, from which bit, with or without the code, plain bits, threshold."""

    number: int
    shift: int
    coded: bool
    plain: int
    threshold: int


# 4 bits or fewer: thresholds 1, 1 and 0 (2 + 2 + 1 > 4).
EXACT = [Block(0, 0, True, 7, 1), Block(0, 22, True, 7, 1), Block(0, 44, False, 20, 0)]
NEAR_SHINGLE = 5
# Near copies share 4 / 5 of their shingles. Of pairs that share just so many, 1 in 65,000 has no band of equal minima:
# (1 - 0.8^5)^28; of pairs that share half, 6 in 10 have one and are turned down by their sets.
BANDS, ROWS = 28, 5
# Of 128 single bits of minima, those of a pair of similarity 0.8 differ in 12.8 on average, and in more than 30 in about 2 cases in 10^6.
SKETCH_BITS, SKETCH_NEAR = 128, 30
# Sets of a coarse group are compared in tiles of so many sets, and so many members, at most; every two tiles meet in one task.
TILE_SETS, TILE_MEMBERS = 400, 500_000
MARK_BITS = 26  # size of the table that tells tasks which texts to take: 8 MB
_random = np.random.default_rng(20)
TIMES, PLUS = (_random.integers(0, 1 << 64, BANDS * ROWS, np.uint64) for _ in range(2))
TIMES |= np.uint64(1)
BY_ROW = _random.integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)
BY_BAND = _random.integers(0, 1 << 64, BANDS, np.uint64)


def words(text: bytes) -> list[bytes]:
    """bytes.split() cuts at blank and x09 to x0D, bytes.lower() changes A-Z only."""
    return text.lower().split()


def shingles(found: list[bytes], n: int) -> list[bytes]:
    if len(found) <= n:
        return [b" ".join(found)] if found else []
    whole = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    return [whole[a : b - 1] for a, b in zip([0, *ends], ends[n - 1 :])]


def majority(digests: list[bytes], counts: list[int], width: int) -> np.ndarray:
    """Bits set in over half the digests of each text; ``counts`` says how many digests follow each other for it."""
    out = np.zeros((len(counts), width * 8), bool)
    at, i = 0, 0
    while i < len(counts):
        j, total = i, 0
        while j < len(counts) and (j == i or total + counts[j] <= 1 << 16):
            total += counts[j]
            j += 1
        n = np.array(counts[i:j])
        full = np.flatnonzero(n)
        if len(full):
            sums = np.zeros((len(full), width * 8), np.int64)
            for s in range(0, total, 1 << 18):  # one very long text may pass in several rounds
                raw = np.frombuffer(b"".join(digests[at + s : at + min(total, s + (1 << 18))]), np.uint8)
                bits = np.unpackbits(raw).reshape(-1, width * 8)
                if j == i + 1:
                    sums[0] += bits.sum(axis=0, dtype=np.int64)
                else:
                    sums += np.add.reduceat(bits, np.cumsum(n[full]) - n[full], axis=0, dtype=np.int32)
            out[i + full] = sums * 2 > n[full][:, None]
        at += total
        i = j
    return out


def numbers(bits: np.ndarray) -> list[np.ndarray]:
    packed = np.packbits(bits, axis=1)
    return [packed[:, k : k + 8].copy().view(">u8")[:, 0].astype(np.uint64).view(np.int64) for k in range(0, packed.shape[1], 8)]


def digested(docs: DataFrame, keep: list[str], kinds: list[tuple[int, Callable[[list[bytes]], list[bytes]]]], names: list[str]) -> DataFrame:
    """Columns ``keep`` and fingerprint numbers of every whole text; each kind gives (bytes of a digest, digests of the words)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [words(t or b"") for t in part.column(len(keep)).cast(pa.binary()).to_pylist()]
                out = []
                for width, hashed in kinds:
                    per_text = [hashed(t) for t in texts]
                    out += numbers(majority([d for p in per_text for d in p], [len(p) for p in per_text], width))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *[pa.array(x) for x in out]], [*keep, *names])

    schema = ", ".join([*[f"`{c}` {t}" for c, t in docs.select(*keep).dtypes], *[f"{n} long" for n in names]])
    return docs.select(*[F.col(c).alias(c) for c in keep], F.col("text").alias("_text")).mapInArrow(made, schema)


def syndrome(v: np.ndarray) -> np.ndarray:
    """Of 15 bits: 0 for a code word, else the number (from 1) of the bit whose flip makes one."""
    s = np.zeros(v.shape, np.int64)
    for i in range(15):
        s ^= np.where(v >> i & 1, i + 1, 0)
    return s


def masks(block: Block) -> list[np.ndarray]:
    """By syndrome, what to flip in a block to get from it to every anchor in reach; the home comes first."""
    if not block.coded:
        assert block.threshold == 0
        return [np.zeros(1, np.int64)]
    reach = 1 + block.threshold
    flips = [m for m in range(1 << block.plain) if m.bit_count() <= reach]
    code = [(m, m.bit_count()) for m in range(1 << 15) if m.bit_count() <= reach]
    by = [[] for _ in range(16)]
    syn = syndrome(np.array([m for m, _ in code]))
    for (m, d), s in zip(code, syn.tolist()):
        by[s] += [(d + f.bit_count(), m | f << 15) for f in flips if d + f.bit_count() <= reach]
    return [np.array([m for _, m in sorted(b)], np.int64) for b in by]


def placed(prints: DataFrame, blocks: list[Block]) -> DataFrame:
    """(anchor, node, c0, c1, home): every copy of every fingerprint. ``prints``: node, k0, k1 (the bits of blocks), c0, c1 (the bits compared)."""

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = [masks(b) for b in blocks]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                node, k0, k1, c0, c1 = (part.column(i).to_numpy() for i in range(5))
                for number, (block, by) in enumerate(zip(blocks, flips)):
                    size = (15 if block.coded else 0) + block.plain
                    v = ((k0, k1)[block.number].view(np.uint64) >> np.uint64(block.shift)).astype(np.int64) & ((1 << size) - 1)
                    syn = syndrome(v & 0x7FFF) if block.coded else np.zeros(len(v), np.int64)
                    for s, mask in enumerate(by):
                        own = np.flatnonzero(syn == s)
                        if len(own):
                            anchor = (v[own][:, None] ^ mask[None, :]).ravel() | number << 40
                            who = np.repeat(own, len(mask))
                            home = np.tile(np.arange(len(mask)) == 0, len(own))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(anchor), pa.array(node[who]), pa.array(c0[who]), pa.array(c1[who]), pa.array(home)],
                                ["anchor", "node", "c0", "c1", "home"])

    return prints.select("node", "k0", "k1", "c0", "c1").mapInArrow(copies, "anchor long, node long, c0 long, c1 long, home boolean")


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of equal connection, at most one per node: (node, smallest node it reaches)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def within(bits: int) -> Callable:
    """Whether fingerprints (c0, c1) differ by ``bits`` or fewer."""

    def near(c0, c1, d0, d1):
        return np.bitwise_count(c0 ^ d0).astype(np.int16) + np.bitwise_count(c1 ^ d1) <= bits

    return near


def compared(alike: Callable) -> Callable:
    """Compare homes and copies of anchors; rows come sorted by anchor and part, homes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 5  # homes of the last anchor, as it may go on in the next batch
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(5)]
            home = batch.column(5).to_numpy(zero_copy_only=False)
            old = len(held[0])
            anchor, part, node, c0, c1 = (np.concatenate([h, c]) for h, c in zip(held, cols))
            home = np.concatenate([np.ones(old, bool), home])
            starts = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))))
            sizes = np.diff(np.append(starts, len(anchor)))
            homes = np.add.reduceat(home.astype(np.int64), starts)
            group = np.repeat(np.arange(len(starts)), sizes)
            partners = np.where(sizes[group] > 1, homes[group], 0)
            partners[:old] = 0
            c0, c1 = c0.view(np.uint64), c1.view(np.uint64)
            a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
            ends, i = np.cumsum(partners), 0
            while i < len(anchor):
                done = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
                n = partners[i:j]
                if n.any():
                    row = np.repeat(np.arange(i, j), n)
                    mate = starts[group[row]] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                    near = alike(c0[row], c1[row], c0[mate], c1[mate]) & (node[row] != node[mate])
                    if near.any():
                        a, b = stars(np.concatenate([a, node[row[near]]]), np.concatenate([b, node[mate[near]]]))
                i = j
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            last = slice(starts[-1], starts[-1] + homes[-1])
            held = [x[last] for x in (anchor, part, node, c0.view(np.int64), c1.view(np.int64))]

    return run


def near_links(prints: DataFrame, blocks: list[Block], bits: int) -> DataFrame:
    """Links (a, b) that connect exactly the nodes that some chain of meeting pairs within ``bits`` connects. ``prints`` has one row per node."""
    return met(placed(prints, blocks), within(bits))


def met(rows: DataFrame, alike: Callable) -> DataFrame:
    """Links (a, b) that connect what the pairs of a home and a copy of one anchor that are ``alike`` connect.

    Anchors with more than HOME_LIMIT homes are split into parts of homes, and their copies go to all parts.
    """
    many = partitions(rows.sparkSession)
    crowded = stored(
        rows.filter("home").groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > HOME_LIMIT)
        .select("anchor", F.ceil(F.col("n") / HOME_LIMIT).cast("long").alias("parts")), "anchors")
    own = F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1)))
    spread = rows.join(crowded, "anchor", "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)))
    return (
        spread.select("anchor", "part", "node", "c0", "c1", (F.col("home") & (F.col("part") == own)).alias("home"))
        .repartition(many, "anchor", "part").sortWithinPartitions("anchor", "part", F.desc("home"))
        .mapInArrow(compared(alike), "a long, b long")
    )


def hashed(found: list[bytes], shingle: int) -> list[bytes]:
    """What a fingerprint is the majority of: the XXH64 (seed 42) of every word shingle, repeats included."""
    return [xxhash.xxh64_digest(s, 42) for s in shingles(found, shingle)]


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 4) -> DataFrame:
    """Columns ``keep`` and ``print``, the 64-bit SimHash of word shingles, repeats included (XXH64, seed 42); 0 without words."""
    return digested(docs, keep, [(8, lambda w: hashed(w, shingle))], ["print"])


def linked_prints(prints: DataFrame) -> DataFrame:
    """(node, root) of the fingerprints, one a row in column ``print``, that chains of links of 4 or fewer differing bits connect; found by anchors."""
    zero = F.lit(0).cast("long")
    own = [F.col("print").alias(c) for c in ("node", "k0", "c0")]
    return components(near_links(prints.select(*own, zero.alias("k1"), zero.alias("c1")), EXACT, 4))


def near_duplicates(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """One row per document: doc_id, print (long), component_id, the smallest doc_id reachable by links of 4 or fewer differing bits.

    Null and empty texts have fingerprint 0, linked like any other. A null id is never the smallest; a component with null ids only has
    a null component_id. Repeated rows stay. Equal fingerprints are one node from the start, so copies make no pairs. Long texts are read whole, their
    digests in rounds; an empty table gives no rows. Other columns of ``docs`` are not read, so their names cannot clash.
    """
    found = stored(fingerprints(docs, ["doc_id"], shingle), "prints")
    nodes = found.groupBy("print").agg(F.min("doc_id").alias("least"))
    member = linked_prints(nodes)
    known = member.join(nodes, member["node"] == nodes["print"]).select("node", "root", "least")
    root = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(known.join(root, "root").select(F.col("node").alias("print"), "component_id"), "components")
    whole = nodes.join(named, "print", "left").select(
        "print", F.when(F.col("component_id").isNotNull(), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    return found.join(whole, "print").select("doc_id", "print", "component_id")


def minima(members: np.ndarray) -> np.ndarray:
    """The least of every permutation of a set of 64-bit hashes."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(members), 1 << 11):
        least = np.minimum(least, (members[at : at + (1 << 11), None] * TIMES + PLUS).min(axis=0))
    return least


def bands(members: np.ndarray, least: np.ndarray) -> np.ndarray:
    """A number for each band of minima of a set; none for an empty set."""
    if not len(members):
        return np.zeros(0, np.int64)
    mixed = (least.reshape(BANDS, ROWS) * BY_ROW).sum(axis=1, dtype=np.uint64) + BY_BAND
    return (mixed ^ mixed >> np.uint64(29)).view(np.int64)


def set_of(found: list[bytes]) -> np.ndarray:
    """The set of five-word shingles as sorted 64-bit hashes."""
    return np.unique(np.array([xxhash.xxh3_64_intdigest(x) for x in set(shingles(found, NEAR_SHINGLE))], np.uint64))


def node_keys(sets: list[np.ndarray]) -> list[pa.Array]:
    keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.tobytes()) for x in sets), np.int64).reshape(-1, 2)
    return [pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy())]


def sketches(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep``, two hashes of the set of shingles of every whole text, the set's size, its bands, 128 bits of its minima (c0, c1), and the fingerprint."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [words(t or b"") for t in part.column(len(keep)).cast(pa.binary()).to_pylist()]
                sets, per_text = [set_of(t) for t in texts], [hashed(t, 4) for t in texts]
                least = [minima(x) for x in sets]
                bits = (np.stack(least)[:, :SKETCH_BITS] >> np.uint64(20) & np.uint64(1)).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], *node_keys(sets), pa.array([len(x) for x in sets]), lists([bands(x, m) for x, m in zip(sets, least)]),
                     *[pa.array(x) for x in numbers(bits) + numbers(majority([d for p in per_text for d in p], [len(p) for p in per_text], 8))]],
                    [*keep, "k0", "k1", "size", "bands", "c0", "c1", "print"])

    schema = ", ".join([*[f"`{c}` {t}" for c, t in docs.select(*keep).dtypes], "k0 long, k1 long, size long, bands array<long>, c0 long, c1 long, print long"])
    return docs.select(*[F.col(c).alias(c) for c in keep], F.col("text").alias("_text")).mapInArrow(made, schema)


def marks(column: DataFrame) -> np.ndarray:
    """The longs of a one-column frame as a bit table of fixed size, 2^MARK_BITS bits: however many there are, no more is sent to tasks."""
    mark = F.col(column.columns[0])
    spots = column.select(F.pmod(mark, F.lit(1 << MARK_BITS)).alias("spot"))
    words = spots.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("spot"), F.lit(64)).cast("int"))).alias("bits"))
    table, found = np.zeros(1 << (MARK_BITS - 6), np.int64), words.toArrow()
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint64)


def sets_of_marked(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """(k0, k1, members) of the whole texts whose ``mark`` is in the table. ``docs``: mark, text. A few more texts pass than were marked."""
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = batch.column(0).to_numpy() & ((1 << MARK_BITS) - 1)
            own = np.flatnonzero(sent.value[spot >> 6] >> (spot & 63).astype(np.uint64) & np.uint64(1))
            for at in range(0, len(own), 64):
                sets = [set_of(words(t or b"")) for t in batch.column(1).take(pa.array(own[at : at + 64])).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*node_keys(sets), lists([x.view(np.int64) for x in sets])], ["k0", "k1", "members"])

    return docs.select("mark", "text").mapInArrow(made, "k0 long, k1 long, members array<long>")


def lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))


def shared_members(sets: list[np.ndarray]) -> np.ndarray:
    """How many members every two sets have in common."""
    sizes = [len(x) for x in sets]
    member, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    often = np.cumsum(times > 1) - 1  # members of one set only are shared with none
    kept = times[at] > 1
    row, column = row[kept], often[at[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, 1 << 12):
        a, b = np.searchsorted(column, [start, start + (1 << 12)])
        block = np.zeros((len(sets), min(1 << 12, width - start)), np.float32)
        block[row[a:b], column[a:b] - start] = 1
        out += block @ block.T
    return out


def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the sets of each two tiles, whose rows follow each other: i / (x + y - i) >= 4 / 5 if 9 i >= 4 (x + y)."""
    held: list[tuple[int, np.ndarray]] = []
    last = None

    def links() -> pa.RecordBatch:
        size = np.array([len(x) for _, x in held], np.float32)
        a, b = np.nonzero(np.triu(shared_members([x for _, x in held]) * 9 >= (size[:, None] + size) * 4, 1))
        node = np.array([n for n, _ in held], np.int64)
        a, b = stars(node[a], node[b]) if len(a) else (node[:0], node[:0])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
        for i, key in enumerate(keys):
            if key != last:
                if len(held) > 1:
                    yield links()
                held, last = [], key
            held.append((batch.column(3)[i].as_py(), batch.column(4)[i].values.to_numpy().copy()))
    if len(held) > 1:
        yield links()


def similar(coarse: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that connect the sets of each coarse group (node, root) that share 4 / 5 of their members.

    Only sets of coarse groups are made. A group is cut into tiles by a hash of the node, and each two tiles meet in a task, so no group is gathered
    and no pair is written.
    """
    grouped = stored(coarse.join(nodes.select("node", "size", "mark"), "node"), "coarse")
    tiles = grouped.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / TILE_SETS), F.ceil(F.sum("size") / TILE_MEMBERS)).cast("long").alias("tiles"))
    found = sets_of_marked(docs, marks(grouped.select("mark"))).withColumn("node", F.xxhash64("k0", "k1"))
    held = found.join(grouped.select("node", "root"), "node").dropDuplicates(["node"]).select("root", "node", "members")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("tiles"))
    spread = held.join(tiles, "root").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rows = spread.select("root", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "node", "members")
    many = partitions(docs.sparkSession)
    return stored(rows.repartition(many, "root", "one", "two").sortWithinPartitions("root", "one", "two").mapInArrow(tiled, "a long, b long"), "similar")


def near_sets(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) of similar nodes. ``nodes``: node, size, bands, c0, c1, mark; ``docs``: mark, text.

    Nodes that meet in a band and whose sketches are near make coarse groups, which hold every similar pair; their sets decide.
    """
    rows = nodes.select(F.explode("bands").alias("anchor"), "node", "c0", "c1", F.lit(True).alias("home"))
    return similar(components(met(rows, within(SKETCH_NEAR))), nodes, docs)


def near_prints(found: DataFrame) -> DataFrame:
    """Links (a, b) that connect the nodes whose fingerprints ``near_duplicates`` connects. ``found``: node, print."""
    own = stored(found.select("node", "print").distinct(), "node_prints")
    member = linked_prints(own.select("print").distinct())
    group = own.join(member.withColumnRenamed("node", "print"), "print", "left").select("node", F.coalesce("root", "print").alias("root")).distinct()
    least = group.groupBy("root").agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1").select("root", "b")
    return group.join(least, "root").filter("node <> b").select(F.col("node").alias("a"), "b")


def first_of_each(docs: DataFrame, prints: bool = False) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest id stays, and all columns with it.

    Two documents are near copies if their sets of five-word shingles (64-bit hashes) have a Jaccard similarity of 0.8 or more, and with ``prints``
    also if ``near_duplicates`` links their fingerprints (4 or fewer differing bits, met at anchors);
    chains of near copies, of either kind, are a group. Texts that meet in a band of minima and whose sketches are near are compared by their whole sets. Rows
    without words are one group. Null ids count as the largest; of rows with one id, one stays by the hash of the whole row.
    """
    narrow = docs.select("doc_id", F.xxhash64("text").alias("spot"), "text")
    found = stored(sketches(narrow, ["doc_id", "spot"]).withColumn("node", F.xxhash64("k0", "k1")), "sketches")
    nodes = stored(
        found.groupBy("node").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "spot")).alias("least"),
            F.first("bands").alias("bands"), F.first("c0").alias("c0"), F.first("c1").alias("c1"), F.first("size").alias("size"))
        # Of exact copies, the first one's set stands for all.
        .withColumn("mark", F.xxhash64("least.doc_id", "least.spot")),
        "nodes")
    links = near_sets(nodes, narrow.select(F.xxhash64("doc_id", "spot").alias("mark"), "text"))
    if prints:
        links = links.unionByName(near_prints(found))
    member = components(links)
    group = nodes.join(member, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("least").alias("least"))
    times = found.groupBy("doc_id", "spot").agg(F.count("*").alias("times"))
    first = group.select(F.col("least.doc_id").alias("_id"), F.col("least.spot").alias("_at"))
    kept = stored(
        first.join(times, F.col("_id").eqNullSafe(F.col("doc_id")) & F.col("_at").eqNullSafe(F.col("spot"))).select("_id", "_at", "times"), "kept")
    keyed = docs.withColumn("_spot", F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_spot") == F.col("_at"))
    # Whole texts move once, past a hash of the narrow side. Rows repeated with id and text, mostly none, are cut to one.
    single = keyed.join(kept.filter("times = 1").hint("shuffle_hash"), same, "left_semi")
    often = keyed.join(stored(kept.filter("times > 1"), "repeated"), same, "left_semi").dropDuplicates(["doc_id", "_spot"])
    return single.unionByName(often).select(*docs.columns)


@query("op5_simhash")
def simhash(spark, sf_dir):
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
