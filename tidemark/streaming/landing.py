"""Incremental landing: pages that arrive as files become canonical rows, each once, with what is set aside beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import exact
from tidemark.operators.admission import quarantine
from tidemark.sources import canonical
from tidemark.sources.pages import kline_rows

FIELDS = ("k", "t", "open", "high", "low", "close", "volume")


def candles_of_pages(pages: DataFrame) -> DataFrame:
    """(k, t, prices and volume in units, reason) of kline pages (json); reason is null for rows that are admitted."""
    rows = kline_rows(pages).withColumn("volume", exact.price_units(F.col("volume")))
    return quarantine(rows).select(*FIELDS, "reason")


def _merge(batch: DataFrame, number: int, path: str, schema) -> None:
    """Put a batch's admitted rows into the table at path/rows and the others into path/quarantine/batch=number.

    The months and buckets that the batch has rows of are rewritten as the union with what is stored, one row for each (k, t);
    dynamic overwrite replaces each partition whole. So a batch that is written again, after a restart or as pages landed
    twice, leaves the table as it is; where two pages disagree on a key, the first that was stored stays.
    """
    spark = batch.sparkSession
    judged = batch.persist()
    try:
        judged.filter("reason is not null").select(*FIELDS, "reason").write.mode("overwrite").parquet(f"{path}/quarantine/batch={number}")
        fresh = canonical.partition_columns(judged.filter("reason is null").select(*FIELDS)).withColumn("__new", F.lit(1))
        touched = [tuple(r) for r in fresh.select(*canonical.PARTITIONS).distinct().collect()]  # months and buckets of a batch
        if not touched:
            return
        stored = spark.read.schema(schema).parquet(f"{path}/rows").withColumn("__new", F.lit(0)) if _exists(spark, f"{path}/rows") else fresh.limit(0)
        place = F.struct(*canonical.PARTITIONS)
        near = stored.filter(place.isin([F.struct(*[F.lit(v).cast("long").alias(c) for v, c in zip(p, canonical.PARTITIONS)]) for p in touched]))
        values = [c for c in FIELDS if c not in ("k", "t")]
        both = near.unionByName(fresh).groupBy(*canonical.PARTITIONS, "k", "t").agg(F.min(F.struct("__new", *values)).alias("first"))
        rows = both.select("k", "t", *[F.col(f"first.{c}") for c in values], *canonical.PARTITIONS)
        kept = rows.repartition(*canonical.PARTITIONS).sortWithinPartitions(*canonical.PARTITIONS, "k", "t")
        kept.write.partitionBy(*canonical.PARTITIONS).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/rows")
    finally:
        judged.unpersist()


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def land(pages: DataFrame, path: str, timeout: int | None = None) -> None:
    """Run a stream of kline pages (json) into the table at `path` until all files that are there now are landed.

    Offsets are checkpointed in path/checkpoint, so the next call goes on from there and reads new files only. See _merge()
    for what a batch writes and why writing it again changes nothing. Quarantined rows, with reasons, are in
    path/quarantine by batch, admitted ones in path/rows, partitioned by year, month and bucket.
    """
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(c, T.LongType()) for c in (*FIELDS, *canonical.PARTITIONS)])
    query = candles_of_pages(pages).writeStream.foreachBatch(lambda batch, number: _merge(batch, number, path, schema))
    query.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination(timeout)
