"""Shortlists, eligible instruments, probe windows and lifecycle jobs on hard rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sampling
from tidemark.sources import ranges

M, DAY = 60_000, 86_400_000
QUOTE = dict(symbol="A", price=100_000, size=1, low=99_000, high=101_000, bid=100_000, ask=100_050, turnover=2_000_000)


def quotes(spark, *changes):
    rows = [tuple({**QUOTE, "symbol": f"S{i:02d}", **c}.values()) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, "symbol string, price long, size long, low long, high long, bid long, ask long, turnover long")


def test_thresholds_of_the_shortlist(spark):
    table = quotes(spark, {}, {"ask": 100_051}, {"high": 114_000}, {"high": 114_001}, {"low": 101_500, "high": 101_000}, {"bid": 100_060}, {"turnover": 999_999}, {"size": 10}, {"low": None},
                   {"turnover": 3_000_000})
    got = sampling.shortlist(table, 9).collect()
    assert [r.symbol for r in got] == ["S09", "S00", "S02"]
    assert (got[1].stop, got[1].lower, got[1].upper, got[1].take) == (89_325, 94_050, 106_050, 111_375)
    assert [r.symbol for r in sampling.shortlist(table, 1).collect()] == ["S09"]
    small = quotes(spark, {"low": 20, "high": 30})  # rounded down, nothing is left between the bounds
    assert sampling.shortlist(small, 9).count() == 0


def test_instruments_that_are_old_enough(spark):
    end = 10_000 * M
    good = ("LinearPerpetual", "USDT", "USDT", "Trading")
    rows = [("B", *good, 8001 * M), ("A", *good, 8001 * M), ("C", *good, 8001 * M + 1), ("D", *good, -1), ("E", *good, None), ("F", *good[:3], "Settled", 0), ("G", "LinearFutures", *good[1:], 0),
            ("H", "LinearPerpetual", "USDC", "USDT", "Trading", 0), ("G", "LinearFutures", *good[1:], 0)]
    schema = "symbol string, contract string, quote string, settle string, status string, launch long"
    table = spark.createDataFrame(rows, schema)
    assert [tuple(r) for r in sampling.oldest_instruments(table, 5, end, 2).collect()] == [("A", 8001 * M), ("B", 8001 * M)]
    assert sampling.oldest_instruments(table, 1, end, 2).count() == 1
    for bad in ("A", "", None):
        with pytest.raises(Exception, match="empty or repeated symbol"):
            sampling.oldest_instruments(table.unionByName(spark.createDataFrame([(bad, *good[:3], "Settled", 0)], schema)), 5, end, 2).collect()


def test_windows_are_clipped(spark):
    year, week = 365 * DAY, 7 * DAY
    targets = spark.createDataFrame([(1, 0, 500 * M), (2, 0, 999 * M), (3, 0, 2000 * M), (4, 0, year + 3 * DAY), (5, 0, 2 * year + 30 * DAY), (6, 5, 4)], "k long, start long, stop long")
    windows = sampling.probe_windows(targets)
    got = {}
    for r in windows.orderBy("k", "start").collect():
        got.setdefault(r.k, []).append((r.kind, r.start, r.stop))
    launch = ("launch", 0, 999 * M)
    assert got == {
        1: [("launch", 0, 500 * M)], 2: [launch], 3: [launch, ("terminal", 1000 * M, 2000 * M)], 4: [launch, ("annual", year, year + 3 * DAY)],
        5: [launch, ("annual", year, year + week - M), ("annual", 2 * year, 2 * year + week - M), ("terminal", 2 * year + 30 * DAY - week + M, 2 * year + 30 * DAY)]}
    rows = spark.createDataFrame([(5, 7 * M), (5, 8 * M), (5, year - M), (5, year), (3, 1000 * M), (3, 1500 * M), (9, 0)], "k long, t long")
    found = {(r.k, r.kind, r.start): (r.observed, r.first_t, r.delay_ms) for r in sampling.probe_results(windows, rows).collect()}
    assert found[5, "launch", 0] == (2, 7 * M, 7 * M) and found[5, "annual", year] == (1, year, 0) and found[3, "terminal", 1000 * M] == (2, 1000 * M, 0)
    assert found[5, "annual", 2 * year] == (0, None, None) and len(found) == windows.count()


def test_jobs_of_living_instruments(spark):
    jan, feb, mar = 1_767_225_600_000, 1_769_904_000_000, 1_772_323_200_000
    asked = spark.createDataFrame([(k, jan, mar - M) for k in (1, 2, 9, 17, 25)], "k long, start long, stop long")
    life = spark.createDataFrame([(1, 0, 0), (2, feb + 1, None), (9, jan + 30, feb), (17, mar, 0)], "k long, launch long, delivery long")
    jobs = {(r.month, r.bucket): [tuple(s) for s in r.series] for r in ranges.lifecycle_jobs(ranges.month_windows(asked), life).collect()}
    assert jobs == {(1, 1): [(1, jan, feb - M), (9, jan + M, feb - M)], (2, 1): [(1, feb, mar - M)], (2, 2): [(2, feb + M, mar - M)]}
    assert ranges.lifecycle_jobs(ranges.month_windows(asked).filter(F.lit(False)), life).count() == 0
