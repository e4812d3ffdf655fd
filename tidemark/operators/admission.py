"""Row rules: what a candle, a settlement or an instrument may not be, and what is set aside rather than rounded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import exact
from tidemark.functions.times import MINUTE

PRICES = ("open", "high", "low", "close")


def _codes(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(rule, F.lit(code)) for code, rule in rules.items()]))


def _lacks(*columns: str) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def candle_violations() -> Column:
    """Codes of the rules that a candle (k, t, open, high, low, close, volume, turnover, category, source_id, ingestion_id,
    quality_flags) breaks. What must be there and is null breaks a rule, so a row without codes has all of it."""
    outside = {p: (F.col(p) < F.col("low")) | (F.col(p) > F.col("high")) for p in ("open", "close")}
    empty = {f"empty_{c}": F.coalesce(F.trim(c), F.lit("")) == "" for c in ("source_id", "category", "ingestion_id")}
    return _codes({
        "null_price": _lacks(*PRICES), "null_volume": _lacks("volume", "turnover"),
        "instrument_id": F.coalesce(F.col("k") <= 0, F.lit(True)), "not_minute_aligned": F.coalesce(F.pmod("t", F.lit(MINUTE)) != 0, F.lit(True)), "negative_time": F.col("t") < 0,
        "non_positive_price": F.least(*PRICES) <= 0, "low_exceeds_high": F.col("low") > F.col("high"),
        "open_outside_low_high": outside["open"], "close_outside_low_high": outside["close"], "negative_volume": F.col("volume") < 0,
        "negative_turnover": F.col("turnover") < 0, **empty, "negative_quality_flags": F.coalesce(F.col("quality_flags") < 0, F.lit(True))})


def quarantine(rows: DataFrame) -> DataFrame:
    """rows with the first reason that sets a candle aside, null for admitted ones; `rejected` ones can't be candles at all:
    a price or the volume is missing, or below what it may be."""
    reason = F.when(_lacks(*PRICES, "volume") | (F.least(*PRICES) <= 0) | (F.col("volume") < 0), "rejected").when(F.col("low") > F.col("high"), "low_exceeds_high")
    for price in ("open", "close"):
        reason = reason.when((F.col(price) < F.col("low")) | (F.col(price) > F.col("high")), f"{price}_outside_low_high")
    return rows.withColumn("reason", reason)


def representation_admission(rows: DataFrame, volume: str = "volume") -> DataFrame:
    """rows with the reason that excludes a volume, below zero or finer than the canonical scale; null for admitted ones."""
    return rows.withColumn("reason", F.when(F.startswith(volume, F.lit("-")), "negative_volume").when(~exact.fits_decimal(F.col(volume), exact.VOLUME_SCALE), "volume_exceeds_canonical_scale"))


def funding_violations() -> Column:
    """Codes of the rules that a settlement (k, t, interval) breaks."""
    return _codes({"instrument_id": F.col("k") <= 0, "not_minute_aligned": F.pmod("t", F.lit(MINUTE)) != 0, "non_positive_interval": F.col("interval") <= 0})


def instrument_violations() -> Column:
    """Codes of the rules that an instrument (tick, step, min/max_quantity, min/max_leverage, launch, delivery) breaks."""
    positive = {f"non_positive_{c}": F.col(c) <= 0 for c in ("tick", "step", "min_quantity", "max_quantity", "min_leverage", "max_leverage")}
    return _codes(positive | {"leverage_bounds": F.col("min_leverage") > F.col("max_leverage"), "quantity_bounds": F.col("min_quantity") > F.col("max_quantity"), "delivery_before_launch": F.col("delivery") < F.col("launch")})
