"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A letter triple is bound to one vector by multiplying its letters' vectors,
each rotated by its place; a text is the sum (bundle) of its triples' vectors, a language the sum of its texts. A text
takes the language whose profile has the largest cosine to it. All sums are whole numbers, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, remainder, table
from tidemark.llm.textbytes import parts, utf8

DIM = 512
LETTERS = 128  # symbol 0 is anything but a letter, 1 to 26 are a to z, other letters share the rest by code point
UNKNOWN = 255


AT_ONCE = 4096  # different trigrams counted at once: scripts of many letters have very many


def letter_vectors() -> np.ndarray:
    return np.random.default_rng(11).choice(np.array([-1, 1], np.int8), (LETTERS, DIM))


class Profiler:
    """Turns texts into bundles; keeps the code points seen so far."""

    def __init__(self) -> None:
        third = letter_vectors()
        self.first, self.second, self.third = np.roll(third, 2, axis=1), np.roll(third, 1, axis=1), third
        self.symbols = np.full(0x110000, UNKNOWN, np.uint8)
        self.place = np.zeros(LETTERS**3, np.int32)

    def symbol(self, text: str) -> np.ndarray:
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        out = self.symbols[code]
        if (out == UNKNOWN).any():
            for c in np.unique(code[out == UNKNOWN]).tolist():
                low = chr(c).lower()[:1]
                if not low.isalpha():
                    self.symbols[c] = 0
                elif "a" <= low <= "z":
                    self.symbols[c] = ord(low) - 96
                else:
                    self.symbols[c] = 27 + ord(low) * 2654435761 % 2**32 % (LETTERS - 27)
            out = self.symbols[code]
        return out

    def bundles(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bundle, has a letter) of each text of a column, whole texts."""
        raw, offsets = utf8(column)
        made = np.zeros((len(column), DIM), np.float64)
        lettered = np.zeros(len(column), bool)
        for rows, marks in parts(raw, offsets):
            data = raw[marks[0] : marks[-1]]
            starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[marks - marks[0]]
            sym = self.symbol(data.tobytes().decode("utf-8", "replace"))
            piece = np.repeat(np.arange(len(rows)), np.diff(starts))
            lettered[rows[np.unique(piece[sym > 0])]] = True
            # A text's ends count as other than letters.
            wide = np.zeros(len(sym) + 2 * len(rows), np.int32)
            whose = np.repeat(np.arange(len(rows)), np.diff(starts) + 2)
            wide[np.arange(len(sym)) + 2 * piece + 1] = sym
            code = (wide[:-2] * LETTERS + wide[1:-1]) * LETTERS + wide[2:]
            ok = (wide[1:-1] > 0) & (whose[:-2] == whose[2:])
            code, whose = code[ok], whose[1:-1][ok]
            here = np.flatnonzero(np.bincount(code, minlength=1)) if len(code) else np.zeros(0, np.int64)
            self.place[here] = np.arange(len(here))
            place = self.place[code]
            part = np.zeros((len(rows), DIM), np.float64)
            for start in range(0, len(here), AT_ONCE):
                some = here[start : start + AT_ONCE]
                own = (place >= start) & (place < start + AT_ONCE)
                counts = np.bincount(whose[own] * len(some) + place[own] - start, minlength=len(rows) * len(some))
                bound = self.first[some // LETTERS**2] * self.second[some // LETTERS % LETTERS] * self.third[some % LETTERS]
                part += counts.reshape(len(rows), len(some)).astype(np.float32) @ bound.astype(np.float32)
            np.add.at(made, rows, np.rint(part))
        return made, lettered


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in code point order and their profiles, from every text with a language.

    Tasks send one partial sum per language; the result is a language's DIM numbers, so its size goes with the number of languages.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, sums = Profiler(), {}
        for batch in batches:
            made, _ = profiler.bundles(batch.column(0))
            for name, at in _groups(batch.column(1)).items():
                sums[name] = sums.get(name, 0) + made[at].sum(axis=0)
        for name, total in sums.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * DIM, pa.string()), "axis": pa.array(np.arange(DIM, dtype=np.int32)),
                "value": pa.array(total.astype(np.int64)),
            })

    sums = (
        docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null and text is not null")
        .mapInArrow(summed, "lang string, axis int, value long").groupBy("lang", "axis").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("axis", "value"))), lambda x: x["value"]).alias("profile"))
        .collect()
    )
    names = sorted(r["lang"] for r in sums)
    by_name = {r["lang"]: r["profile"] for r in sums}
    return names, np.array([by_name[n] for n in names], np.float64).reshape(len(names), DIM)


def _groups(column: pa.Array) -> dict[str, np.ndarray]:
    coded = column.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    return {name: np.flatnonzero(index == i) for i, name in enumerate(coded.dictionary.to_pylist())}


def predict(docs: DataFrame, names: list[str], profiles: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every document, ``lang_pred`` and ``score`` (the cosine, 0 to 1).

    A text that is null, empty or without letters is ``und`` with score 0, as is every text if nothing was learned. Of
    languages with equal cosine the first by code point wins. Texts of any length are bundled whole, in pieces; repeated rows are predicted alike; an
    empty table gives no rows. Columns ``lang_pred`` and ``score`` among ``keep`` would clash with the result's.
    """
    norms = np.linalg.norm(profiles, axis=1)
    unit = profiles / np.where(norms > 0, norms, 1)[:, None]
    shared = docs.sparkSession.sparkContext.broadcast((names, unit))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, (known, axes) = Profiler(), shared.value
        for batch in batches:
            made, lettered = profiler.bundles(batch.column(len(keep)))
            if known:
                size = np.linalg.norm(made, axis=1)
                near = made @ axes.T / np.where(size > 0, size, 1)[:, None]
                best = near.argmax(axis=1)
                found = [known[b] if ok else "und" for b, ok in zip(best, lettered)]
                value = np.where(lettered, np.clip(near.max(axis=1), 0, 1), 0.0)
            else:
                found, value = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(found, pa.string()), pa.array(value)], [*keep, "lang_pred", "score"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes) + ", lang_pred string, score double"
    return docs.select(*[F.col(c).alias(c) for c in keep], F.col(text).alias("_text")).mapInArrow(named, schema)


@query("op4_language")
def language(spark, sf_dir):
    """Language of every document by profiles of the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    out = remainder(F.col("doc_id"), 4) == 2
    names, profiles = learn(docs.filter(~out))
    return predict(docs, names, profiles, ["doc_id"]).select("doc_id", out.alias("held_out"), "lang_pred", "score")
