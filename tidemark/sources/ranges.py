"""Cutting requested ranges into pages and calendar months."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.exact import stable_bucket
from tidemark.functions.times import MINUTE, ceil_minute, date_ms, utc_date


def range_tiling(requests: DataFrame, minutes: int) -> DataFrame:
    """(k, page_start, page_end) of pages of so many minutes that tile each request (k, start, stop; inclusive)."""
    pages = requests.select("k", "stop", F.explode(F.sequence("start", "stop", F.lit(minutes * MINUTE))).alias("page_start"))
    return pages.select("k", "page_start", F.least(F.col("page_start") + (minutes - 1) * MINUTE, F.col("stop")).alias("page_end"))


def month_windows(requests: DataFrame) -> DataFrame:
    """(k, year, month, start, stop) of each request split at UTC month edges."""
    first, last = (F.trunc(utc_date(F.col(c)), "month") for c in ("start", "stop"))
    months = F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("m")
    cut = requests.select("k", F.col("start").alias("a"), F.col("stop").alias("b"), months)
    end = date_ms(F.add_months("m", 1)) - MINUTE
    return cut.select("k", F.year("m").cast("long").alias("year"), F.month("m").cast("long").alias("month"), F.greatest("a", date_ms(F.col("m"))).alias("start"), F.least(F.col("b"), end).alias("stop"))


def lifecycle_jobs(windows: DataFrame, instruments: DataFrame) -> DataFrame:
    """(year, month, bucket, series) jobs of month windows (k, year, month, start, stop) clipped to instruments (k, launch, delivery).

    A series begins at the first whole minute at or after its launch and ends with the last one before its delivery, where
    it has one (null or 0: none). What doesn't reach into a month, and instruments that aren't listed, give nothing; series
    of a job, those of a month and bucket, are (k, start, stop) by k.
    """
    delivery = F.nullif("delivery", F.lit(0))
    life = instruments.select("k", ceil_minute(F.col("launch")).alias("first"), (ceil_minute(delivery) - MINUTE).alias("last"))
    cut = windows.join(life, "k").withColumns({"start": F.greatest("start", "first"), "stop": F.least("stop", "last")}).filter("start <= stop")
    series = F.struct("k", "start", "stop")
    return cut.groupBy("year", "month", stable_bucket(F.col("k")).alias("bucket")).agg(F.sort_array(F.collect_list(series)).alias("series"))  # instruments of one bucket
