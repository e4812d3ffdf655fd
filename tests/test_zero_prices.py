"""Bars and pages with prices of 0 or less."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.functions import exact
from tidemark.operators import profiles
from tidemark.plans import registry
from tidemark.streaming.landing import candles_of_pages

registry.load()


def test_distribution_of_zero_prices(spark):
    rows = [(1, 0, 150, 0, 150, 2, 150), (1, 60_000, 200, 100, 130, 1, 200), (2, 0, 0, 0, 0, 1, 0), (3, 0, 500, 200, 225, 1, 500)]
    bars = spark.createDataFrame(rows, "k long, t long, high long, low long, close long, volume long, turnover long")
    got = {r.k: (r.closes, r.low, r.high, r.dynamic_range, r.whole, r.places) for r in profiles.value_distribution(bars).collect()}
    assert got == {1: (2, 0, 200, None, 0, 1), 2: (1, 0, 0, None, 1, 0), 3: (1, 200, 500, 25_000, 0, 2)}


def test_pages_of_zero_prices(spark, tmp_path):
    values = [(0, 0.0), (0, 1.5), (30, 0.0), (61, -0.05), (62, -2.0), (120, -1.95), (180, None), (86_400, 0.01), (86_460, 100.0)]
    events = ", ".join(f"({i}, timestamp '2024-01-01' + interval {s} second, {i % 2}, 'view', {'null' if v is None else v}, '')" for i, (s, v) in enumerate(values * 2))
    duck = duckdb.connect()
    duck.execute(f"create table events as select event_id::bigint as event_id, ts, user_id::bigint as user_id, event_type, value::double as value, props from (values {events}) x(event_id, ts, user_id, event_type, value, props)")
    duck.execute(f"copy events to '{tmp_path}/events.parquet' (format parquet)")
    want = duck.sql(registry.ORACLE_SQL["A3_read_kline_pages"])
    got = registry.QUERIES["A3_read_kline_pages"](spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


@pytest.mark.parametrize("text,units", [
    ("0", 0), ("0.00", 0), ("-0.05", -5_000_000), ("-1.95", -195_000_000), ("+7", 700_000_000), ("100.00000001", 10_000_000_001), ("92233720368.54775807", 9_223_372_036_854_775_807),
    ("-92233720368.54775807", -9_223_372_036_854_775_807), ("-92233720368.54775809", None), ("92233720368.54775808", None), ("-0.000000001", None), ("1e5", None), ("--1", None), ("", None), (None, None)])
def test_units_of_any_sign(spark, text, units):
    assert spark.createDataFrame([(text,)], "x string").select(exact.price_units(F.col("x"), signed=True)).first()[0] == units


def test_pages_with_zero_prices_are_not_admitted(spark):
    rows = [["0", "0.00", "1", "0.00", "1", "1", "1"], ["60000", "1", "1", "-1", "1", "1", "1"], ["120000", "1", "1", "1", "1", "1", "1"], ["180000", "1", "1", "0.000000001", "1", "1", "1"]]
    landed = spark.createDataFrame([(json.dumps({"k": 1, "kind": "trade", "rows": rows}),)], "json string")
    got = {r.t: (r.low, r.reason) for r in candles_of_pages(landed).collect()}
    assert got == {0: (0, "rejected"), 60_000: (-100_000_000, "rejected"), 120_000: (100_000_000, None), 180_000: (None, "rejected")}
