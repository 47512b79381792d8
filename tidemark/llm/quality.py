"""Quality classifier: supervised subword embeddings.

Words, pairs of neighbouring words and character n-grams inside words are hashed to rows of a learned table of
vectors. A document is the average of its vectors, a softmax layer turns it into the class, and both are trained by
stochastic gradient descent in numpy. As average and layer are linear up to the softmax, a trained row counts only by its
product with the layer: scoring sums one number per feature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, remainder, table
from tidemark.llm.textbytes import SPACE, parts, utf8

BITS = 17  # 2^17 rows of the table
DIM = 8
GRAMS = (3, 4)
TRAIN_ROWS = 4000  # bound of the labelled sample that the model is fitted on
EPOCHS = 6
RATE = 20.0
MIX = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.full(64, 0x100000001B3, np.uint64).cumprod()


def features(raw: np.ndarray, marks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(piece, hashed feature) of each feature of the pieces between ``marks``, kind by kind."""
    data = raw[marks[0] : marks[-1]]
    begin = marks[:-1] - marks[0]
    piece = np.repeat(np.arange(len(begin), dtype=np.int32), np.diff(marks))
    space = SPACE[data]
    shift = np.uint64(64 - BITS)
    if not len(data):
        return
    # Words, and pairs of words.
    first = np.zeros(len(data), bool)
    first[begin[begin < len(data)]] = True
    inner = ~space
    starts = np.flatnonzero(inner & (first | np.concatenate(([True], space[:-1]))))
    if len(starts):
        place = np.zeros(len(data), np.int64)
        place[starts[0] :] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
        value = np.where(inner, (data.astype(np.uint64) + np.uint64(1)) * POWERS[place & 63], np.uint64(0))
        word = np.add.reduceat(value, starts)
        at = piece[starts]
        yield at, (word * MIX) >> shift
        same = at[1:] == at[:-1]
        # A pair is hashed by the difference of its words, so that repeats of any word share one feature.
        yield at[1:][same], ((word[1:] - word[:-1] + np.uint64(5)) * MIX)[same] >> shift
    # Character n-grams: white space may stand at their ends only, as the word's border.
    wide = data.astype(np.uint64)
    gram = wide
    for n in range(2, max(GRAMS) + 1):
        if len(data) < n:
            return
        gram = (gram[:-1] << np.uint64(8)) | wide[n - 1 :]
        if n in GRAMS:
            ok = piece[: len(gram)] == piece[n - 1 :]
            for k in range(1, n - 1):
                ok &= inner[k : k + len(gram)]
            yield piece[: len(gram)][ok], ((gram[ok] + np.uint64(n << 40)) * MIX) >> shift


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a whole text and their shares."""
    raw, offsets = utf8(pa.array([text]))
    total = np.zeros(1 << BITS, np.float32)
    for _, marks in parts(raw, offsets):
        for _, feature in features(raw, marks):
            total += np.bincount(feature.astype(np.int64), minlength=1 << BITS)
    seen = np.flatnonzero(total)
    return seen, total[seen] / max(1.0, float(total.sum()))


def train(texts: list[str], labels: list[int], seed: int = 7) -> np.ndarray:
    """Fit vectors and softmax; returns one weight per table row and, last, the bias.

    Without examples of both classes the model is flat: score 0.5 for a lack of rows, else the only class.
    """
    rng = np.random.default_rng(seed)
    vectors = (rng.random((1 << BITS, DIM), np.float32) - 0.5) / DIM
    layer, bias = (rng.random((DIM, 2), np.float32) - 0.5) / DIM, np.zeros(2, np.float32)
    rows = [counted(t) for t in texts]
    steps = EPOCHS * len(rows)
    done = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            seen, share = rows[i]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            hidden = share @ vectors[seen]
            out = hidden @ layer + bias
            out = np.exp(out - out.max())
            grad = out / out.sum()
            grad[labels[i]] -= 1
            back = layer @ grad
            layer -= rate * np.float32(0.05) * np.outer(hidden, grad)
            bias -= rate * np.float32(0.0005) * grad
            vectors[seen] -= rate * share[:, None] * back
    return np.append(vectors @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0]).astype(np.float32)


def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sample = pd.concat(list(batches), ignore_index=True).sort_values(["spot", "doc_id"], kind="stable")
    model = train(sample["text"].tolist(), sample["label"].tolist())
    yield pd.DataFrame({"model": [model.tobytes()]})


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> np.ndarray:
    """Fit on at most ``rows`` labelled documents, those with the smallest hash of their id.

    ``labels``: doc_id and the label 0/1; rows with nulls teach nothing, repeated labels teach once, without any the model is zero. The sample is drawn before texts are joined, so
    only its texts move; one task trains.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
        .distinct().withColumn("spot", F.xxhash64("doc_id")).orderBy("spot", "doc_id", "label").limit(rows)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sample = chosen.join(texts, "doc_id").select("doc_id", "spot", "label", "text")
    made = sample.repartition(1).mapInPandas(fitted, "model binary").collect()
    return np.frombuffer(bytes(made[0]["model"]), np.float32) if made else np.zeros((1 << BITS) + 1, np.float32)


def score(docs: DataFrame, model: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every document and ``score``, the probability of label 1 for its whole text.

    A null or empty text has no features and gets the bias alone. The model has a fixed size (2^17 + 1 numbers). Long texts are read whole, in
    pieces; repeated rows are scored alike; equal scores need no order; an empty table gives no rows. A column named ``score`` among ``keep`` would clash
    and has to be renamed by the caller, as the pipeline does with all columns it does not know.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            raw, offsets = utf8(batch.column(len(keep)))
            total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for rows, marks in parts(raw, offsets):
                for piece, feature in features(raw, marks):
                    total += np.bincount(rows[piece], weights[feature.astype(np.int64)], batch.num_rows)
                    count += np.bincount(rows[piece], minlength=batch.num_rows)
            logit = np.clip(total / np.maximum(count, 1) + weights[-1], -50, 50)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(1 / (1 + np.exp(-logit)))], [*keep, "score"])

    kept = docs.select(*keep)
    schema = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes) + ", score double"
    return docs.select(*[F.col(c).alias(c) for c in keep], F.col(text).alias("_text")).mapInArrow(scored, schema)


def learnable(labels: DataFrame) -> DataFrame:
    return labels.filter(remainder(F.col("doc_id"), 3) != 1)


@query("op2_quality")
def quality(spark, sf_dir):
    """Score of every document by a model of the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, learnable(table(spark, sf_dir, "labels")))
    return score(docs, model, ["doc_id"]).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
