"""The canonical layout: fixed schemas, month and bucket partitions, sorted files, manifests, pruned scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.exact import stable_bucket
from tidemark.functions.times import utc_date

PARTITIONS = ("year", "month", "bucket")
CODEC, LEVEL = "zstd", 3


class SchemaMismatch(ValueError):
    """Stored columns that aren't those of the contract."""


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df, if its columns have the names and types of schema in order; nothing is inferred or cast."""
    have, want = [(f.name, f.dataType) for f in df.schema], [(f.name, f.dataType) for f in schema]
    if have != want:
        raise SchemaMismatch(f"columns {have} aren't {want}")
    return df


def partition_columns(rows: DataFrame) -> DataFrame:
    """rows (k, t) with the UTC year and month of t and the bucket of k."""
    day = utc_date(F.col("t"))
    return rows.withColumns({"year": F.year(day).cast("long"), "month": F.month(day).cast("long"), "bucket": stable_bucket(F.col("k"))})


def write_canonical(rows: DataFrame, path: str) -> None:
    """One sorted set of files for each month and bucket; rows meet in their partition's task in one shuffle.

    Skewed partitions are split into several files by the rebalance.
    """
    placed = partition_columns(rows).hint("rebalance", *[F.col(c) for c in PARTITIONS])
    placed.sortWithinPartitions(*PARTITIONS, "k", "t").write.partitionBy(*PARTITIONS).option("compression", CODEC).option(
        "parquet.compression.codec.zstd.level", LEVEL).mode("errorifexists").parquet(path)


def read_canonical(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A canonical table with its partition columns, read under the given schema and checked against what is stored."""
    stored = spark.read.parquet(path)
    assert_schema(stored.drop(*PARTITIONS), schema)
    parts = [T.StructField(c, T.LongType()) for c in PARTITIONS]
    return spark.read.schema(T.StructType([*schema.fields, *parts])).parquet(path)


def months_between(start_ms: int, end_ms: int) -> list[tuple[int, int]]:
    import datetime as dt

    first, last = (dt.datetime.fromtimestamp(x / 1000, dt.timezone.utc) for x in (start_ms, end_ms))
    return [(n // 12, n % 12 + 1) for n in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]


def scan_selection(table: DataFrame, start_ms: int, end_ms: int, ids: list[int] | None = None) -> DataFrame:
    """Exactly the rows of an inclusive range and of the listed instruments (None: all).

    The filters name year, month and bucket, so other partitions aren't listed or read, and k and t, so
    row groups are skipped by their bounds.
    """
    wanted: Column = F.lit(False)
    for year, month in months_between(start_ms, end_ms):
        wanted |= (F.col("year") == year) & (F.col("month") == month)
    rows = table.filter(wanted & F.col("t").between(start_ms, end_ms))
    if ids is not None:
        rows = rows.filter(F.col("bucket").isin(sorted({i % 8 for i in ids})) & F.col("k").isin(ids))
    return rows


def manifest(table: DataFrame) -> DataFrame:
    """Rows, instruments and key bounds of each stored file."""
    return table.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("rows"), F.countDistinct("k").alias("instruments"), F.min("k").alias("first_k"), F.max("k").alias("last_k"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


def partition_manifest(table: DataFrame) -> DataFrame:
    """Rows, instruments and key bounds of each month and bucket."""
    return table.groupBy(*PARTITIONS).agg(
        F.count("*").alias("rows"), F.countDistinct("k").alias("instruments"), F.min("k").alias("first_k"), F.max("k").alias("last_k"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


def empty_partition(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table with the schema and no rows, for partitions into which nothing is admitted."""
    return spark.createDataFrame([], schema)
