"""Texts of an Arrow batch as one numpy array of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and len + 1 offsets into them; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def parts(raw: np.ndarray, offsets: np.ndarray, limit: int = 1 << 18, most: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cut a batch into runs of about ``limit`` bytes and at most ``most`` pieces: (row of each piece, len + 1 offsets of pieces).

    Short texts stay whole; a text beyond the limit comes in pieces that end at white space where there is any.
    """
    rows: list[int] = []
    marks: list[int] = []
    held = 0
    for row in range(len(offsets) - 1):
        start, end = int(offsets[row]), int(offsets[row + 1])
        while start < end:
            stop = end
            if end - start > limit:
                cut = np.flatnonzero(SPACE[raw[start + limit // 2 : start + limit]])
                stop = start + limit // 2 + int(cut[-1]) + 1 if len(cut) else start + limit
            if rows and (held + stop - start > limit or len(rows) == most):
                yield np.array(rows), np.array([*marks, start])
                rows, marks, held = [], [], 0
            rows.append(row)
            marks.append(start)
            held += stop - start
            start = stop
    if rows:
        yield np.array(rows), np.array([*marks, int(offsets[-1])])


def overlapping(offsets: np.ndarray, limit: int, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (row, start, end) of about ``limit`` bytes, without texts shorter than ``window``.

    Pieces of one text overlap, so that every stretch of ``window`` bytes is whole in one of them.
    """
    held: list[tuple[int, int, int]] = []
    size = 0
    for row in range(len(offsets) - 1):
        start, end = int(offsets[row]), int(offsets[row + 1])
        while end - start >= window:
            stop = min(end, start + max(limit, 2 * window))
            if held and size + stop - start > limit:
                yield held
                held, size = [], 0
            held.append((row, start, stop))
            size += stop - start
            if stop == end:
                break
            start = stop - window + 1
    if held:
        yield held
