"""A skip index for substring search: which files can hold a term.

For each file of a table the index has a bit table of hashed trigrams (three bytes of the text in lower case). A term can only stand in a file that has all of
its trigrams, so a search opens those files and filters their rows exactly. The index is kept in words of 64 bits, sorted by their place, and a search reads
the places of its own trigrams only. Files are indexed once; files the index does not know are always searched, and terms shorter than a
trigram search all files, so no match is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
BITS = 18  # bits of a file's table, as a power of two: 32 KB
HELD = 32  # files whose tables a task holds at once
FACTOR = 0x9E3779B1


def spots(raw: np.ndarray) -> np.ndarray:
    """The bit of each trigram of the bytes."""
    if len(raw) < GRAM:
        return np.zeros(0, np.int64)
    wide = raw.astype(np.uint64)
    grams = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
    return ((grams * np.uint64(FACTOR) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - BITS)).astype(np.int64)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def words() -> Iterator[pa.RecordBatch]:
        for file, bits in held.items():
            packed = np.packbits(bits, bitorder="little").view("<i8")
            own = np.flatnonzero(packed)
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(own), pa.string()), pa.array(own.astype(np.int32)), pa.array(packed[own])], ["file", "word", "bits"])
        held.clear()

    for batch in batches:
        # Rows of one file follow each other. Trigrams across two texts only add bits.
        runs = pc.run_end_encode(batch.column(0))
        start = 0
        for file, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            text = batch.column(1).slice(start, end - start)
            if file not in held:
                if len(held) == HELD:
                    yield from words()
                held[file] = np.zeros(1 << BITS, bool)
            text = text.cast(pa.large_binary())
            _, ends, data = text.buffers()
            at = np.frombuffer(ends, np.int64)[text.offset : text.offset + len(text) + 1]
            if data is not None:
                held[file][spots(np.frombuffer(data, np.uint8)[at[0] : at[-1]])] = True
            start = end
    yield from words()


def build(rows: DataFrame, text: Column) -> DataFrame:
    """The index (file, word, bits) of ``text`` over the files that ``rows`` were read from. A null text has no trigrams."""
    named = rows.select(F.col("_metadata.file_path").alias("file"), F.coalesce(F.lower(text), F.lit("")).cast("binary").alias("text"))
    parts = named.mapInArrow(_tables, "file string, word int, bits long")
    return parts.groupBy("file", "word").agg(F.bit_or("bits").alias("bits"))


def write(index: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Sorted by word, so that a search reads the row groups of its own words. New files are appended."""
    index.repartitionByRange(*(["word", "file"])).sortWithinPartitions("word", "file").write.mode(mode).parquet(path)


def needed(term: str) -> dict[int, int]:
    """Bits a file must have to hold the term (in lower case), by word; none for a term shorter than a trigram."""
    out: dict[int, int] = {}
    for spot in spots(np.frombuffer(term.encode(), np.uint8)).tolist():
        out[spot >> 6] = out.get(spot >> 6, 0) | 1 << (spot & 63)
    return {w: m - (1 << 64) if m >> 63 else m for w, m in out.items()}


def files_with(index: DataFrame, term: str) -> DataFrame:
    """The files (column file) that can hold the term, which is in lower case."""
    bits = needed(term)
    mask = F.lit(None).cast("long")
    for word, own in bits.items():
        mask = F.when(F.col("word") == word, F.lit(own)).otherwise(mask)
    has = index.filter(F.col("word").isin(list(bits))).filter(F.col("bits").bitwiseAND(mask) == mask)
    return has.groupBy("file").agg(F.count("*").alias("n")).filter(F.col("n") == len(bits)).select("file")


def search(rows: DataFrame, index: DataFrame, text: Column, term: str) -> DataFrame:
    """Rows of a table whose ``text`` holds the term, whatever its case; only files that can hold it are read.

    ``rows`` is the table as read, ``index`` one of it or of some of its files. Names of files, which the driver lists for any scan, are compared there.
    """
    spark = rows.sparkSession
    low = spark.range(1).select(F.lower(F.lit(term))).first()[0]  # as Spark has it, which the index is made by
    exact = F.lower(text).contains(low)
    if not needed(low):
        return rows.filter(exact)
    can, known = ({plain(r["file"]) for r in files.collect()} for files in (files_with(index, low), index.select("file").distinct()))
    chosen = [f for f in rows.inputFiles() if plain(f) in can or plain(f) not in known]
    if not chosen:
        return rows.limit(0)
    return spark.read.schema(rows.schema).parquet(*chosen).filter(exact)


def plain(file: str) -> str:
    """file:///a, file:/a and /a are one file."""
    return "/" + file.removeprefix("file:").lstrip("/") if file.startswith(("file:", "/")) else file
