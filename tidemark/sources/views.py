"""The given star tables seen as market data: ticks, bars, settlements, snapshots, instruments, tickers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.times import HOUR, MINUTE, epoch_ms


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, t, price in cents, event_id, kind) of the events."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") + 1).alias("k"), epoch_ms(F.col("ts")).alias("t"),
        F.round(F.col("value") * 100).cast("long").alias("price"), "event_id", F.col("event_type").alias("kind"))


def bars(rows: DataFrame, step: int = MINUTE) -> DataFrame:
    """Bars of ticks: open and close by (time, event), high, low, volume (ticks) and turnover (their sum)."""
    at = F.struct("t", "event_id")
    return rows.groupBy("k", (F.col("t") - F.pmod("t", F.lit(step))).alias("t")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", at).alias("close"), F.count("*").alias("volume"), F.sum("price").alias("turnover"))


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(ticks(spark, sf_dir))


def hour_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(ticks(spark, sf_dir), HOUR)


def settlement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, t, rate in units, id) of the orders; a few keys (k, t) repeat."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + 1).alias("k"), epoch_ms(F.col("o_orderdate")).alias("t"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("rate"), F.col("o_orderkey").alias("id"))


def settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """settlement_rows with the first id of each key."""
    return settlement_rows(spark, sf_dir).groupBy("k", "t").agg(F.min_by("rate", "id").alias("rate"), F.min("id").alias("id"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, t, status, symbol, launch) of the orders as dated metadata, one for each key."""
    rows = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + 1).alias("k"), epoch_ms(F.col("o_orderdate")).alias("t"), F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("symbol"))
    return rows.groupBy("k", "t").agg(F.min_by("status", "id").alias("status"), F.min_by("symbol", "id").alias("symbol"), F.min("id").alias("id"))


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, t, line) of line items: the order's customer at the ship date."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", epoch_ms(F.col("l_shipdate")).alias("t"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") + 1).alias("k"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "k", "t", "l_orderkey", F.col("l_linenumber").cast("long").alias("line"), "l_partkey")


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, symbol, name, kind, price in cents, size) of the parts."""
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("k"), F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit("USDT")).alias("symbol"),
        F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_brand").alias("brand"),
        F.round(F.col("p_retailprice") * 100).cast("long").alias("price"), F.col("p_size").cast("long").alias("size"))


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, low, high, turnover, n) of line items by part; prices are cents for one item."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    each = F.floor(cents / F.col("l_quantity").cast("long"))
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.min(each).alias("low"), F.max(each).alias("high"), F.sum(cents).alias("turnover"), F.count("*").alias("n"),
    ).select(F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit("USDT")).alias("symbol"), "low", "high", "turnover", "n")
