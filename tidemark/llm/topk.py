"""Exact top-k inner products by an impact-ordered index, a score at a time.

Vectors are dealt to blocks. A block's index holds, for each component, its rows in order of their value, cut into segments of
equal quantised value. A query meets segments by falling impact, the largest share that a segment's rows can still add to the
score over the component's least one, and adds that impact to its rows. At any time a row's score lies between what it has and
that plus what its open components can still give, so rows that cannot reach the k-th best lower bound are out. The query
stops only when few enough rows can still be members, or all segments are done; those rows are scored again exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, query, stored, table

BLOCK_ROWS = 8192
QUERY_ROWS = 2048
STEP = 16  # values v of one segment share v // STEP
LEVELS = (0.5, 0.2, 0.1, 0.05)  # impacts, as shares of the largest, down to which the segments are met before each look
COUNT = 16  # bits of the counter of components
FEW = 128  # rows, or a third of the block, that are rescored without a further look


def whole_numbers(vector: Column) -> Column:
    """floor(1024 * x) of each component as double; null if the vector or a component is null or not finite."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(ok, F.transform(vector, lambda x: F.floor(x.cast("double") * 1024.0).cast("long")))


class Block:
    """The index of a block: per component the rows by value, and where each quantised value starts."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.sort(values, axis=0).T.copy()
        self.shifted = self.sorted // STEP * STEP << COUNT
        self.low, self.high = values.min(axis=0), values.max(axis=0)

    def best(self, q: np.ndarray, k: int) -> np.ndarray:
        """Rows that hold the k highest scores with all ties: a proven superset, found segment by segment."""
        n, width = self.values.shape
        if n <= max(k, FEW) or not width:
            return np.arange(n)
        # Impacts count from each component's least contribution, so they are never negative.
        up = q > 0
        least = np.where(up, q * self.low, q * self.high)
        most = np.where(up, q * self.high, q * self.low) - least
        slack = int(np.abs(q).sum()) * (STEP - 1)  # all that quantisation can hide
        if float(np.abs(most.astype(np.float64)).sum()) + float(np.abs(q * (np.abs(self.low) + np.abs(self.high)).astype(np.float64)).sum()) + slack >= 1 << 45:
            return np.arange(n)  # impacts would not fit beside the counter: all rows are scored
        met = np.zeros(n, np.int64)  # 2^COUNT times the impacts so far, plus the number of components met
        done = np.zeros(width, np.int64)
        asked = int((q != 0).sum())
        for level in (*LEVELS, 0.0):
            bar = int(level * most.max())
            for d in np.flatnonzero((most >= bar) & (q != 0)):
                w, s = int(q[d]), self.sorted[d]
                # Segments whose impact reaches the bar: for w > 0 those of high values, else those of low ones.
                if w > 0:
                    edge = -(-(bar + int(least[d])) // w) // STEP * STEP
                    cut = n - int(np.searchsorted(s, edge, "left"))
                    at = slice(n - cut, n - int(done[d]))
                    most_off = 0
                else:
                    edge = (bar + int(least[d])) // w
                    edge = edge // STEP * STEP + STEP - 1
                    cut = int(np.searchsorted(s, edge, "right"))
                    at = slice(int(done[d]), cut)
                    most_off = STEP - 1
                if cut > done[d]:
                    met[self.order[d, at]] += w * self.shifted[d, at] + (((w * most_off - int(least[d])) << COUNT) + 1)  # lower bounds
                    done[d] = cut
            total = met >> COUNT
            floor = np.partition(total, n - k)[n - k]
            rest = (asked - (met & ((1 << COUNT) - 1))) * bar
            alive = np.flatnonzero(total + slack + rest >= floor)
            if len(alive) <= max(FEW, n // 3):
                break
        return alive


def searched(k: int):
    def run(key, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        def matrix(t: pa.Table) -> np.ndarray:
            return t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)

        out: list[tuple] = []
        if vectors.num_rows and queries.num_rows:
            block, qs = Block(matrix(vectors)), matrix(queries)
            ids = vectors.column("id").to_pylist()
            uid = vectors.column("uid").to_numpy()
            shown = np.array([(x is None, 0 if x is None else x) for x in ids], dtype=[("no", bool), ("id", np.int64)])
            for q, quid, qid in zip(qs, queries.column("uid").to_pylist(), queries.column("id").to_pylist()):
                rows = block.best(q, min(k + 1, len(ids)))  # one more, as the query's own row does not count
                rows = rows[uid[rows] != quid]
                scores = block.values[rows] @ q
                for i in np.lexsort((uid[rows], shown["id"][rows], shown["no"][rows], -scores))[:k]:
                    out.append((quid, qid, int(uid[rows[i]]), ids[rows[i]], int(scores[i])))
        names = ["quid", "query_id", "uid", "vec_id", "score"]
        return pa.table({n: pa.array([o[i] for o in out], pa.int64()) for i, n in enumerate(names)})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of each query row by integer inner product, exactly.

    Candidates are all rows but the query's own, also rows with equal ids. Ties go to the smaller id, null ids last. Vectors that are
    null or hold null or non-finite components take no part; vectors are compared with those of the same length. The sum of a query's products, each
    taken as positive and with its component's largest value, must stay below 2^60. An empty table gives no rows; other columns are not read. Blocks of vectors meet blocks of queries; no block holds more than about BLOCK_ROWS and QUERY_ROWS rows.
    """
    spark = vectors.sparkSession
    rows = stored(
        vectors.select(F.col(id_col).cast("long").alias("id"), whole_numbers(F.col(vector)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        .filter("v is not null").withColumn("uid", F.monotonically_increasing_id()), "vectors")
    n, asked = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    blocks, rounds = n // BLOCK_ROWS + 1, asked // QUERY_ROWS + 1
    every = rows.withColumn("size", F.size("v"))
    left = (
        every.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
        .withColumn("round", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rounds - 1).cast("long")))).select("size", "block", "round", "uid", "id", "v")
    )
    right = (
        every.filter("asks").withColumn("round", F.pmod(F.xxhash64("uid", F.lit(5)), F.lit(rounds)))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).select("size", "block", "round", "uid", "id", "v")
    )
    keys = ["size", "block", "round"]
    tasks = min(partitions(spark), int(blocks * rounds))
    found = (
        left.repartition(tasks, *keys).groupBy(*keys).cogroup(right.repartition(tasks, *keys).groupBy(*keys))
        .applyInArrow(searched(k), "quid long, query_id long, uid long, vec_id long, score long")
    )
    best = Window.partitionBy("quid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024.0::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.n <> c.n AND len(q.e) = len(c.e)
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
) WHERE rank <= 10
"""


@query("op8_topk", SQL)
def topk(spark, sf_dir):
    """Ten best inner products of every hundredth vector against all others."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 100 == 0)
