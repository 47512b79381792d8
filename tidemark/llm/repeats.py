"""Repeated byte strings by a sparse enhanced suffix array.

Only some suffixes are indexed: every window of WINDOW bytes picks its anchor, the GRAM-byte string in it with the smallest hash, so
equal windows have equal anchors at equal places. Neighbouring windows with one anchor form a run, and a run's span holds all bytes of
its windows. Runs with an anchor that occurs once are done. Spans that occur twice as they are, are repeated throughout. What is left are
anchors with several different spans: their suffixes are sorted, and a stack scan over the lengths of common prefixes yields the
tree of common-prefix intervals. In each interval the members' left contexts, sorted too, tell how far the repeat extends to
the left for each of them; members that differ to the left by less than the window's length are one group of a maximal repeat,
and all its occurrences are marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, query, stored, table
from tidemark.llm.textbytes import overlapping, utf8

WINDOW, GRAM = 200, 40
CHUNK = 1 << 19  # bytes handled at once
PLACE = np.uint64((1 << 20) - 1)
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
GROUP_LIMIT = 20_000  # different spans of an anchor that one task holds

RUN = "m long, c long, doc_id long, h long, at int, x int, n int, twice boolean"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place."""
    wide = data.astype(np.uint64)
    for k in (1, 2, 4):
        wide = wide[:-k] | wide[k:] << np.uint64(8 * k)
    n = len(data) - GRAM + 1
    total = wide[:n] * FACTORS[0]
    for j in range(1, GRAM // 8):
        total += wide[8 * j : 8 * j + n] * FACTORS[j]
    total ^= total >> np.uint64(29)
    total *= FACTORS[1]
    total ^= total >> np.uint64(32)
    return total


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def runs_of(pieces: list[tuple[int, int, int]], raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Columns m, c, row, at, x, n of the runs of some pieces of texts."""
    data = np.concatenate([raw[s:e] for _, s, e in pieces])
    lengths = np.array([e - s for _, s, e in pieces])
    begins = np.cumsum(lengths) - lengths
    piece = np.repeat(np.arange(len(pieces)), lengths)
    full = gram_hashes(data)
    marked = full & ~PLACE | np.arange(len(full), dtype=np.uint64)
    place = (sliding_minimum(marked, WINDOW - GRAM + 1) & PLACE).astype(np.int64)
    whole = np.flatnonzero(piece[: len(place)] == piece[WINDOW - 1 :])
    anchor = place[whole]
    cut = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1] + 1))))
    first, last = whole[cut], whole[np.append(cut[1:], len(whole)) - 1]
    anchor, n = anchor[cut], last - first + WINDOW
    text = data.tobytes()
    spans = [xxhash.xxh64_intdigest(text[a:b], 3) for a, b in zip(first.tolist(), (first + n).tolist())]
    whose = piece[first]
    row = np.array([p[0] for p in pieces])[whose]
    origin = np.array([s - int(offsets[r]) for r, s, _ in pieces])
    return [full[anchor].view(np.int64), np.array(spans, np.uint64).view(np.int64), row, first - begins[whose] + origin[whose], anchor - first, n]


def find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of all texts. Of runs with one span in a batch only the first keeps its anchor, and all are known to be repeated:
    the others take keys of their own, so that a very common line or passage does not gather in one task."""
    for batch in batches:
        raw, offsets = utf8(batch.column(2))
        made = [runs_of(pieces, raw, offsets) for pieces in overlapping(offsets, CHUNK, WINDOW)]
        if not made:
            continue
        m, c, row, at, x, n = (np.concatenate(cols) for cols in zip(*made))
        order = np.lexsort((c, m))
        same = (m[order][1:] == m[order][:-1]) & (c[order][1:] == c[order][:-1])
        twice = np.zeros(len(m), bool)
        twice[order[1:][same]] = True
        later = np.flatnonzero(twice)
        twice[order[:-1][same]] = True
        keys = batch.column(1).take(pa.array(row))
        own = (keys.to_numpy().view(np.uint64)[later] + at[later].astype(np.uint64)) * FACTORS[2]
        m[later] = (own ^ own >> np.uint64(31)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(m), pa.array(c), batch.column(0).take(pa.array(row)), keys, pa.array(at.astype(np.int32)),
             pa.array(x.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(twice)],
            ["m", "c", "doc_id", "h", "at", "x", "n", "twice"])


VERDICT = "ask boolean, " + RUN


def judge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs come sorted by anchor and span. Out go all runs whose span occurs twice, and (``ask``) one run of each span of
    anchors with several spans. One row is held back between batches, and one as an anchor's only span so far."""
    names = ["m", "c", "doc_id", "h", "at", "x", "n"]
    held: pa.Table | None = None
    before, several, waiting = False, False, None  # of the held row: same span as the row before; anchor has several spans

    def out(rows: pa.Table, ask: bool, twice: np.ndarray) -> pa.RecordBatch:
        made = rows.combine_chunks().to_batches()
        cols = made[0].columns[: len(names)] if made else [pa.array([], t) for t in rows.schema.types[: len(names)]]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(twice), ask)), *cols, pa.array(twice)], ["ask", *names, "twice"])

    def step(rows: pa.Table, final: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, before, several, waiting
        m, c = rows.column("m").to_numpy(), rows.column("c").to_numpy()
        same = (m[1:] == m[:-1]) & (c[1:] == c[:-1])
        prior, after = np.concatenate(([before], same)), np.append(same, False)
        done = len(m) if final else len(m) - 1
        twice = prior | after | rows.column("twice").to_numpy()
        fresh = ~prior
        starts = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1])))
        kinds = np.add.reduceat(fresh.astype(np.int64), starts)  # spans first seen here, per anchor
        if several:
            kinds[0] += 2
        elif waiting is not None:
            kinds[0] += 1
        many = kinds >= 2
        if waiting is not None and many[0]:
            yield out(waiting[0], True, waiting[1])
            waiting = None
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(m))))
        emit = np.flatnonzero(twice[:done])
        if len(emit):
            yield out(rows.take(pa.array(emit)), False, twice[emit])
        ask = np.flatnonzero(fresh[:done] & many[group[:done]])
        if len(ask):
            yield out(rows.take(pa.array(ask)), True, twice[ask])
        if not final:
            tail = len(starts) - 1
            several = bool(many[tail])
            if tail > 0 or several:
                waiting = None
            own = np.flatnonzero(fresh[:done] & (group[:done] == tail))
            if not several and len(own):
                waiting = (rows.slice(int(own[0]), 1), twice[own[:1]])
            held, before = rows.slice(done, 1), bool(prior[done])

    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            yield from step(pa.concat_tables([held, rows]) if held is not None else rows, False)
    if held is not None:
        yield from step(held, True)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    high = min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    low = 0
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """The common-prefix interval tree, children first: (length, first, last) of a suffix array; lcp[i] belongs to i - 1 and i."""
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        length = lcp[i] if i < len(lcp) else -1
        left = i - 1
        while stack and stack[-1][0] > length:
            top, left = stack.pop()
            yield top, left, i - 1
        if length >= 0 and (not stack or stack[-1][0] < length):
            stack.append((length, left))


def maximal_repeats(rights: list[bytes], lefts: list[bytes], least: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Groups of occurrences of repeats of ``least`` bytes or more around one anchor: (bytes to the right, [(member, bytes to the left)]).

    ``rights`` are the suffixes from the anchor on, ``lefts`` the bytes before it, last first. A member's length to the left is the longest
    that it shares with another member, so its repeat can't be extended to the left within the group.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [0] + [common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    most = max(map(len, lefts))
    rank: list[int] | None = None
    for length, first, last in intervals(lcp):
        if length + most < least:
            continue
        if rank is None:
            rank = [0] * len(lefts)
            for r, i in enumerate(sorted(range(len(lefts)), key=lefts.__getitem__)):
                rank[i] = r
        members = sorted(order[first : last + 1], key=rank.__getitem__)
        shared = [0, *[common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])], 0]
        # Left diversity: where neighbours share too little to the left, the members fall apart into other groups.
        group = [(i, max(shared[k], shared[k + 1])) for k, i in enumerate(members)]
        group = [(i, left) for i, left in group if left + length >= least]
        if group:
            yield length, group


def sweep_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans come sorted by anchor; repeated pieces of spans that occur once go out as (doc_id, h, at, n)."""
    out: list[tuple] = []

    def close(rows: list[tuple]) -> None:
        if len(rows) < 2:
            return
        rights = [r[6][r[5] :] for r in rows]
        lefts = [r[6][: r[5]][::-1] for r in rows]
        for right, group in maximal_repeats(rights, lefts, WINDOW):
            for i, left in group:
                _, twice, doc, h, at, x, _ = rows[i]
                if not twice:
                    out.append((doc, h, at + x - left, left + right))

    def flush() -> pa.RecordBatch:
        cols = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
        out.clear()
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "h", "at", "n"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if held and held[0][0] != row[0]:
                close(held)
                held = []
            held.append(row)
        if len(out) > 10_000:
            yield flush()
    close(held)
    if out:
        yield flush()


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the asked spans out of each text."""
    for batch in batches:
        rows = {k: [] for k in ("m", "twice", "doc_id", "h", "at", "x", "span")}
        texts = batch.column(2).cast(pa.binary())
        for i in range(batch.num_rows):
            text = texts[i].as_py() or b""
            for q in batch.column(3)[i].as_py():
                for k, v in zip(rows, (q["m"], q["twice"], batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), q["at"], q["x"], text[q["at"] : q["at"] + q["n"]])):
                    rows[k].append(v)
            if len(rows["m"]) > 5000:
                yield spans_batch(rows)
                rows = {k: [] for k in rows}
        yield spans_batch(rows)


def spans_batch(rows: dict[str, list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], list(rows))


def windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For anchors with very many spans: a row per window with its digest, so that counting spreads over all tasks."""
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            m, twice, doc, h, at, _, span = row
            places = range(len(span) - WINDOW + 1)
            digests = [xxhash.xxh3_128_intdigest(span[i : i + WINDOW], 9) for i in places]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(d >> 64) - 2**63 for d in digests], pa.int64()), pa.array([(d & 2**64 - 1) - 2**63 for d in digests], pa.int64()),
                 pa.array([twice] * len(digests), pa.bool_()), pa.array([doc] * len(digests), pa.int64()),
                 pa.array([h] * len(digests), pa.int64()), pa.array([at + i for i in places], pa.int32())],
                ["d1", "d2", "twice", "doc_id", "h", "at"])


def repeated_pieces(docs: DataFrame) -> DataFrame:
    """(doc_id, h, at, n): pieces of texts, in bytes, made of WINDOW-byte strings that start elsewhere too. ``h`` is the text's hash."""
    many = partitions(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    judged = stored(
        keyed.mapInArrow(find_runs, RUN).repartition(many, "m").sortWithinPartitions("m", "c").mapInArrow(judge_runs, VERDICT), "runs")
    asked = judged.filter("ask").groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(
        F.collect_set(F.struct("m", "twice", "at", "x", "n")).alias("asked"))
    # Whole texts move past a hash of the narrow side.
    met = keyed.join(asked.hint("shuffle_hash"), keyed["doc_id"].eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")))
    spans = stored(
        met.select("doc_id", "h", "text", "asked").mapInArrow(sliced, "m long, twice boolean, doc_id long, h long, at int, x int, span binary"), "spans")
    crowded = stored(spans.groupBy("m").agg(F.count("*").alias("k")).filter(F.col("k") > GROUP_LIMIT).select("m"), "crowded")
    swept = (
        spans.join(crowded, "m", "left_anti").repartition(many, "m").sortWithinPartitions("m")
        .mapInArrow(sweep_anchors, "doc_id long, h long, at int, n int")
    )
    rows = spans.join(crowded, "m").select("m", "twice", "doc_id", "h", "at", "x", "span").repartition(many).mapInArrow(
        windowed, "d1 long, d2 long, twice boolean, doc_id long, h long, at int")
    often = rows.groupBy("d1", "d2").agg(F.count("*").alias("k")).filter("k > 1")
    counted = rows.join(often, ["d1", "d2"]).filter("not twice").select("doc_id", "h", "at", F.lit(WINDOW).alias("n"))
    return judged.filter("not ask").select("doc_id", "h", "at", "n").unionByName(swept).unionByName(counted)


def reduced(text: bytes, pieces: list[dict]) -> tuple[int, int, bytes]:
    """(bytes removed, runs removed, what is left)."""
    kept: list[bytes] = []
    at = removed = runs = 0
    for start, end in sorted((p["at"], p["at"] + p["n"]) for p in pieces):
        if start > at or not runs:
            kept.append(text[at:start])
            runs += 1
            at = start
        if end > at:
            removed += end - at
            at = end
    kept.append(text[at:])
    return removed, runs, b"".join(kept)


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal runs), kept (binary).

    Every byte goes that is covered by a WINDOW-byte string that starts anywhere else too, in this or another document. A null text is
    empty; documents with equal ids or without one are documents of their own, as ids are used with the text's hash only.
    Repeated rows are copies and lose all text of WINDOW bytes or more. Other columns are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, batch.num_rows, 500):
                made = []
                for i in range(at, min(at + 500, batch.num_rows)):
                    text = texts[i].as_py() or b""
                    made.append((len(text), *reduced(text, batch.column(2)[i].as_py() or [])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 500), *[pa.array([m[k] for m in made], pa.int64()) for k in range(3)], pa.array([m[3] for m in made], pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    pieces = repeated_pieces(docs).groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(F.collect_set(F.struct("at", "n")).alias("pieces"))
    met = keyed.join(pieces.hint("shuffle_hash"), keyed["doc_id"].eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    return met.select("doc_id", "text", "pieces").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


@query("op10_repeats")
def repeats(spark, sf_dir):
    """What every document keeps when repeated 200-byte strings go."""
    made = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
