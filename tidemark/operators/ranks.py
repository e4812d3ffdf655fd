"""Ranks and order statistics over whole tables without a task that sees them whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.sources.shared import checkpoints

#: Buckets that a pass of exact_quantiles() cuts a range into.
BUCKETS = 1024
#: Bits of monotonically_increasing_id() below the partition's number.
ROW_BITS = 33


def global_rank(rows: DataFrame, *order) -> tuple[DataFrame, int]:
    """(rows with their `rank` from 0 in a total order, number of rows).

    Rows are dealt into sampled ranges of the order, sorted there and numbered, and kept in the shared folder; the counts
    of ranges, a row for each, then give every range its offset. Rows that are equal in the order are in one range
    and have any order among them. Nulls come first.
    """
    checkpoints(rows.sparkSession)
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = dealt.withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__id", ROW_BITS)
    counts = numbered.groupBy(part.alias("__part")).agg(F.count("*").alias("__count"))
    offsets = counts.withColumn("__before", F.sum("__count").over(Window.orderBy("__part")) - F.col("__count"))  # a row for each range
    placed = numbered.withColumn("__part", part).join(F.broadcast(offsets), "__part")  # as many rows as ranges
    rank = F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.select(*rows.columns, rank.alias("rank")), numbered.count()


def rank_within(rows: DataFrame, by: str, *order) -> DataFrame:
    """rows with their `place` from 1 in the order of each group `by`; a hot group fills many ranges."""
    placed, _ = global_rank(rows, by, *order)
    first = placed.groupBy(by).agg(F.min("rank").alias("__first"))
    met = placed.join(first.withColumnRenamed(by, "__by"), F.col(by).eqNullSafe(F.col("__by")))
    return met.select(*rows.columns, (F.col("rank") - F.col("__first") + 1).alias("place"))


def exact_quantiles(rows: DataFrame, by: str, value: str, fractions: tuple[float, ...]) -> DataFrame:
    """(by, fraction, value): the least value that has at least the fraction of its group's values at or below it.

    value holds integers; nulls are left out, as are groups without values. Every pass counts the values of a group in
    BUCKETS buckets between two bounds, finds the bucket of the wanted rank and goes on inside it, until the bounds meet:
    four or five passes for 40 bits, whatever the ties, and no task holds a group's values.
    """
    checkpoints(rows.sparkSession)
    values = rows.filter(F.col(value).isNotNull()).select(F.col(by).alias("g"), F.col(value).cast("long").alias("v"))
    wanted = F.explode(F.array(*[F.lit(float(f)) for f in fractions])).alias("fraction")
    state = values.groupBy("g").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n")).select("g", wanted, "low", "high", "n")
    state = state.select("g", "fraction", "low", "high", F.greatest(F.ceil(F.col("fraction") * F.col("n")), F.lit(1)).cast("long").alias("rank")).checkpoint()
    while not state.filter("low < high").isEmpty():
        open_ = state.filter("low < high").withColumn("width", F.expr(f"(high - low) div {BUCKETS} + 1"))
        inside = values.join(open_.withColumnRenamed("g", "__g"), F.col("g").eqNullSafe(F.col("__g"))).filter("v between low and high")
        counts = inside.groupBy("g", "fraction", "low", "high", "width", "rank", F.expr("(v - low) div width").alias("b")).agg(F.count("*").alias("c"))
        line = Window.partitionBy("g", "fraction").orderBy("b")
        reached = counts.withColumn("upto", F.sum("c").over(line)).filter("upto >= rank and upto - c < rank")
        next_low = F.col("low") + F.col("b") * F.col("width")
        moved = reached.select("g", "fraction", next_low.alias("low"), F.least(F.col("high"), next_low + F.col("width") - 1).alias("high"), (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"))
        state = state.filter("low = high").unionByName(moved).checkpoint()
    return state.select(F.col("g").alias(by), "fraction", F.col("low").alias(value))
