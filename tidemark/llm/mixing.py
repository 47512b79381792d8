"""Mixing sources to target weights, in DataFrame functions only.

The words of a source, document after document, are packed into blocks of fixed length. An output shard
holds a fixed number of slots; the counts of its slots per source are drawn with the sources' shares as
probabilities. A source's slots, numbered across shards, go through a pseudorandom permutation of its block
numbers, and slots and packed documents meet in a join on the block number.

The multinomial counts are drawn by stratified uniforms: slot i of a shard of n slots takes the source whose
share of [0, 1] holds (i + u) / n, with u pseudorandom. The counts stay random with the right means, but differ
from them by less than two slots a shard. Counts of a whole shard follow from the two slots at a share's borders,
so slots need not be looked up one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, query, stored, table, words_count

P = 2147483647  # a prime; the hashes below stay under 2^62, so any SQL engine can follow them


def scramble(x: Column, key: Column) -> Column:
    """A pseudorandom number in [0, P) from two numbers. ``x`` occurs once, so nested calls stay small."""
    return (x * 48271 + (key * 69069 + 362437) % P) % P * 1103515245 % P


def permuted(index: Column, rows: Column, cols: Column, key: Column) -> Column:
    """A permutation of 0 .. rows * cols - 1: rounds that add a hash of one coordinate to the other."""
    left, right = F.floor(index / cols), index % cols
    for i in range(2):
        left = (left + scramble(right, key + 2 * i)) % rows
        right = (right + scramble(left, key + 2 * i + 1)) % cols
    return left * cols + right


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """source, source_size, rank, weight, target. One row per source, so plain windows do.

    Sources by code point, null last, take the weights in turn; their targets add up to ``share`` of all sizes
    and stop at ``cap`` times the source's size, the excess going to the others by weight until none is above.
    In order of cap / weight, the first source that stays below its cap fixes the level for all after it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("rank", F.row_number().over(by_name).cast("long") - 1).withColumn("weight", pick)
        .withColumn("most", F.col("source_size") * F.lit(float(cap))).withColumn("reach", F.col("most") / F.col("weight"))
    )
    order = Window.orderBy("reach", "rank")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    return (
        ranked.withColumn("level", level).withColumn("place", F.row_number().over(order))
        .withColumn("first", F.min(F.when(F.col("level") < F.col("reach"), F.col("place"))).over(everything))
        .withColumn("final", F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(everything))
        .withColumn("target", F.when(F.col("place") >= F.col("first"), F.col("final") * F.col("weight")).otherwise(F.col("most")))
        .select("source", "source_size", "rank", "weight", "target")
    )


def running(df: DataFrame, key: str, part: str, order: list[str], value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` within ``key`` by ``part``, then ``order``.

    A key may hold most rows: sums of parts come first, so no task sees more than one part of a key. Sizes behind an
    explode are guessed far too small, so joins with them are asked not to broadcast.
    """
    whole = df.groupBy(key, part).agg(F.sum(value).alias("_part")).withColumn(
        "_before", F.sum("_part").over(Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_part"),
    ).drop("_part")
    w = Window.partitionBy(key, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(whole.hint("merge"), [key, part]).withColumn(out, F.col("_before") + F.sum(value).over(w) - F.col(value)).drop("_before")
    )


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
    block_words: int = 32, shard_slots: int = 8192, part_rows: int = 20000,
) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target (of its source), taken (words the mix takes, repeats counted).

    A block is taken at most ``cap`` times, so no document gives more than ``cap`` times its size. A null text has size 0
    and gives nothing; null sources are one source, the last; a null id is a row of its own, and repeated rows are
    documents of their own. Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    many = partitions(spark)
    base = stored(docs.select("doc_id", "source", words_count(F.col("text")).alias("size")), "mix_sizes")
    padded = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    # Blocks of a source, padded with empty ones to a rectangle that the permutation works on, and its share of slots.
    blocks = F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)).cast("long")
    sources = stored(
        padded.withColumn("blocks", blocks).withColumn("rows", F.ceil(F.sqrt("blocks")).cast("long"))
        .withColumn("cols", F.ceil(F.col("blocks") / F.col("rows")).cast("long"))
        .withColumn("slots", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("rows") * F.col("cols")).otherwise(0.0))
        .withColumn("until", F.sum("slots").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("all_slots", F.sum("slots").over(Window.partitionBy()))
        .withColumn("shards", F.ceil(F.col("all_slots") / shard_slots).cast("long"))
        .withColumn("per_shard", F.coalesce(F.ceil(F.try_divide("all_slots", "shards")), F.lit(0)).cast("long")),
        "mix_sources",
    )

    # Counts per shard and source.
    def drawn(at: Column) -> Column:
        """The number of the shard's points that lie below the share ``at``."""
        x = at * F.col("per_shard")
        i = F.floor(x)
        u = scramble(i, F.col("luck")) / F.lit(float(P))
        return i + F.when(u < x - i, 1).otherwise(0)

    last = F.col("rank") == F.max("rank").over(Window.partitionBy())
    edges = sources.withColumn("hi", F.when(last, F.lit(1.0)).otherwise(F.try_divide("until", "all_slots"))).withColumn(
        "lo", F.coalesce(F.lag("hi").over(Window.orderBy("rank")), F.lit(0.0)))
    cells = edges.filter("shards > 0").withColumn("shard", F.explode(F.expr("sequence(0L, shards - 1)"))).repartition(many, "rank", "shard")
    cells = cells.withColumn("luck", scramble(F.col("shard"), F.lit(7).cast("long")))
    counts = (
        cells.withColumn("n", drawn(F.col("hi")) - drawn(F.col("lo"))).filter("n > 0")
        .withColumn("part", F.floor(F.col("shard") / 1024)).select("rank", "shard", "part", "n", "rows", "cols")
    )
    slots = (
        running(counts, "rank", "part", ["shard"], "n", "first").repartition(many, "rank", "shard")
        .withColumn("slot", F.explode(F.expr("sequence(first, first + n - 1)")))
        .filter(F.col("slot") < F.col("rows") * F.col("cols") * int(cap))
    )
    size = F.col("rows") * F.col("cols")
    block = permuted(F.col("slot") % size, F.col("rows"), F.col("cols"), F.col("rank") * 16)
    times = slots.select("rank", block.alias("block")).groupBy("rank", "block").agg(F.count("*").alias("times"))

    # Packed documents.
    parts = F.lit(1) + F.floor(F.lit(base.count()) / part_rows)
    known = base.join(sources, base["source"].eqNullSafe(sources["source"])).select(
        "doc_id", "size", base["source"], "source_size", "target", "rank", F.pmod(F.coalesce("doc_id", F.lit(0)), parts).alias("part"))
    packed = running(known.filter("size > 0"), "rank", "part", ["doc_id", "size"], "size", "start")
    pieces = (
        packed.withColumn("block", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
        .withColumn("held", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest(F.col("start"), F.col("block") * block_words))
    )
    taken = (
        pieces.join(times.hint("merge"), ["rank", "block"], "left").groupBy("rank", "start", "doc_id", "size", "source", "source_size", "target")
        .agg(F.sum(F.col("held") * F.coalesce("times", F.lit(0))).alias("taken"))
    )
    out = ["doc_id", "size", "source", "source_size", "target", "taken"]
    return taken.select(out).unionByName(known.filter("size = 0").withColumn("taken", F.lit(0).cast("long")).select(out))


SQL = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), ranked AS (
  SELECT *, [3.0, 1.0, 2.0][rank % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most FROM (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM base GROUP BY source)
), levels AS (
  SELECT *, row_number() OVER w AS place, most / weight AS reach,
         (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
            - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked WINDOW w AS (ORDER BY most / weight, rank)
), firsts AS (
  SELECT *, min(CASE WHEN level < reach THEN place END) OVER () AS first FROM levels
), aimed AS (
  SELECT *, CASE WHEN place >= first THEN max(CASE WHEN place = first THEN level END) OVER () * weight ELSE most END AS target FROM firsts
), blocked AS (
  SELECT *, ceil(blocks / rows)::BIGINT AS cols FROM (
    SELECT *, ceil(sqrt(blocks))::BIGINT AS rows FROM (
      SELECT *, greatest(ceil(source_size / 32), 1)::BIGINT AS blocks FROM aimed))
), slotted AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size * rows * cols ELSE 0.0 END::DOUBLE AS slots FROM blocked
), sources AS (
  SELECT *, ceil(all_slots / 8192)::BIGINT AS shards, ceil(all_slots / nullif(ceil(all_slots / 8192), 0))::BIGINT AS per_shard FROM (
    SELECT *, sum(slots) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) AS until, sum(slots) OVER () AS all_slots FROM slotted)
), edges AS (
  SELECT *, coalesce(lag(hi) OVER (ORDER BY rank), 0.0) AS lo FROM (
    SELECT *, CASE WHEN rank = max(rank) OVER () THEN 1.0 ELSE until / all_slots END::DOUBLE AS hi FROM sources)
), cells AS (
  SELECT *, unnest(generate_series(0, shards - 1)) AS shard FROM edges WHERE shards > 0
), counts AS (
  SELECT rank, shard, rows, cols, points(hi, per_shard, shard) - points(lo, per_shard, shard) AS n FROM cells
), offsets AS (
  SELECT *, sum(n) OVER (PARTITION BY rank ORDER BY shard ROWS UNBOUNDED PRECEDING) - n AS first FROM counts WHERE n > 0
), slot_rows AS (
  SELECT rank, rows, cols, unnest(generate_series(first::BIGINT, (first + n - 1)::BIGINT)) AS slot FROM offsets
), s0 AS (
  SELECT rank, rows, cols, (slot % (rows * cols)) // cols AS l, (slot % (rows * cols)) % cols AS r FROM slot_rows WHERE slot < rows * cols * 2
), s1 AS (SELECT rank, rows, cols, r, (l + scramble(r, rank * 16)) % rows AS l FROM s0),
s2 AS (SELECT rank, rows, cols, l, (r + scramble(l, rank * 16 + 1)) % cols AS r FROM s1),
s3 AS (SELECT rank, rows, cols, r, (l + scramble(r, rank * 16 + 2)) % rows AS l FROM s2),
s4 AS (SELECT rank, rows, cols, l, (r + scramble(l, rank * 16 + 3)) % cols AS r FROM s3),
times AS (SELECT rank, l * cols + r AS block, count(*) AS times FROM s4 GROUP BY ALL),
known AS (
  SELECT doc_id, size, base.source, source_size, target, rank,
         ((coalesce(doc_id, 0) % parts) + parts) % parts AS part, row_number() OVER () AS n
  FROM base JOIN sources ON base.source IS NOT DISTINCT FROM sources.source
       CROSS JOIN (SELECT 1 + count(*) // 20000 AS parts FROM base)
), packed AS (
  SELECT *, sum(size) OVER (PARTITION BY rank ORDER BY part, doc_id NULLS FIRST, size, n ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start
  FROM known WHERE size > 0
), pieces AS (
  SELECT *, unnest(generate_series(start // 32, (start + size - 1) // 32)) AS block FROM packed
), taken AS (
  SELECT n, sum((least(start + size, (block + 1) * 32) - greatest(start, block * 32)) * coalesce(times, 0))::BIGINT AS taken
  FROM pieces LEFT JOIN times USING (rank, block) GROUP BY n
)
SELECT doc_id, size, source, source_size, target, coalesce(taken, 0) AS taken FROM known LEFT JOIN taken USING (n)
"""


def inlined(sql: str) -> str:
    """Write the two arithmetic helpers out, as one statement cannot define functions."""
    import re

    p = str(P)

    def hashed(x: str, key: str) -> str:
        return f"((({x}) * 48271 + (({key}) * 69069 + 362437) % {p}) % {p} * 1103515245 % {p})"

    def points(at: str, n: str, shard: str) -> str:
        i = f"floor({at} * {n})::BIGINT"
        u = f"{hashed(i, hashed(shard, '7'))}::DOUBLE / {p}.0::DOUBLE"
        return f"({i} + CASE WHEN {u} < {at} * {n} - {i} THEN 1 ELSE 0 END)"

    sql = re.sub(r"points\((\w+), (\w+), (\w+)\)", lambda m: points(*m.groups()), sql)
    return re.sub(r"scramble\(([^,()]+), ([^,()]+)\)", lambda m: hashed(*m.groups()), sql)


@query("op9_source_mix", inlined(SQL))
def source_mix(spark, sf_dir):
    """All documents mixed to the sources' target weights."""
    return mix_sources(table(spark, sf_dir, "documents"))
