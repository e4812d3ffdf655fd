"""Digests of multisets of rows, and differences of tables narrowed to the partitions that differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.sources.shared import checkpoints

LOW = 0xFFFFFFFF


def partition_digests(table: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """(by, n, digest) of each partition: sums over its rows of a 128-bit hash of the columns, in four parts of 32 bits.

    The order of rows doesn't matter and repeats count. Only sums are shuffled, a row for each partition and task. A null is
    told from all values, and no column's value passes for another's. Up to 2**31 rows a partition.
    """
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    hashes = [F.xxhash64(F.lit(seed), nulls, *columns) for seed in (1, 2)]
    parts = [part for h in hashes for part in (h.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(h, 32))]
    names = [f"__part{i}" for i in range(len(parts))]
    sums = table.select(*by, *[p.alias(n) for p, n in zip(parts, names)]).groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names])
    return sums.select(*by, "n", F.struct("n", *names).alias("digest"))


def differing_partitions(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """The partitions (by) whose rows aren't the same multiset, those that one side lacks with them; by is never null."""
    columns = [c for c in left.columns if c not in by]
    one, two = (partition_digests(df, columns, by).select(*by, F.col("digest").alias(name)) for df, name in ((left, "__l"), (right, "__r")))
    return one.join(two, by, "full_outer").filter(~F.col("__l").eqNullSafe(F.col("__r"))).select(*by)


def table_difference_by_partition(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Rows of one table that the other lacks, counting repeats, with the `side` that has them.

    Digests of partitions are compared first; rows of those that differ alone are shuffled and compared. Tables whose
    digests agree are proven equal without a shuffle of rows.
    """
    checkpoints(left.sparkSession)
    right = right.select(*left.columns)
    changed = differing_partitions(left, right, by).checkpoint()
    if changed.isEmpty():
        return left.limit(0).withColumn("side", F.lit("left"))
    one, two = (df.join(changed, by, "left_semi").select(*left.columns) for df in (left, right))
    return one.exceptAll(two).withColumn("side", F.lit("left")).unionByName(two.exceptAll(one).withColumn("side", F.lit("right")))
