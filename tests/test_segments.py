"""Segmented scans against loops over whole histories, with histories cut at random."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features, segments
from tidemark.sources import pages

M, DAY = 60_000, 86_400_000


def history(pick, n, gap=40, null=0.0):
    t, out = pick.randrange(-3 * DAY, DAY) // M * M, []
    for _ in range(n):
        t += M * pick.choice([1, 1, 1, pick.randrange(1, gap)])
        close = pick.randrange(100, 200)
        row = [close + pick.randrange(9), close - pick.randrange(9), close, pick.randrange(50)]
        out.append((t, close, *[None if pick.random() < null else x for x in row]))
    return out


def table_of(spark, histories):
    rows = [(k, *row) for k, h in histories.items() for row in h]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k long, t long, open long, high long, low long, close long, volume long").withColumn("turnover", F.lit(7)).repartition(5)


def by_hand(rows, w):
    """The features of one history, row by row; nulls are skipped as aggregates skip them."""
    out, ranges, rolled = {}, [], []
    for i, (t, _, high, low, close, volume) in enumerate(rows):
        prev = rows[i - 1][4] if i else None
        parts = [abs(a - b) for a, b in ((high, low), (high, prev), (low, prev)) if a is not None and b is not None]
        ranges.append(max(parts) if parts else None)
        last, full = rows[max(0, i - w + 1) : i + 1], i >= w - 1
        mean = lambda xs: sum(x for x in xs if x is not None) / w if full else None
        best = lambda f, xs: f([x for x in xs if x is not None], default=None) if full else None
        mid, top, bottom = mean([r[4] for r in last]), best(max, [r[2] for r in last]), best(min, [r[3] for r in last])
        prior = rolled[-1] if i else (None, None, None)
        rolled.append((mid, top, bottom))
        width = top - bottom if None not in (top, bottom) else None
        sure = lambda *xs: None not in xs
        crossing = sure(prev, close, prior[0]) and ((prev <= prior[0] < close) or (prev >= prior[0] > close))
        out[t] = (prev, ranges[-1], mid, mean(ranges[max(0, i - w + 1) : i + 1]), mean([r[5] for r in last]), top, bottom, *prior, width,
                  (close - bottom) / width if width and close is not None else None, sure(low, prior[2]) and low <= prior[2], sure(high, prior[1]) and high >= prior[1], crossing)
    return out


NAMES = ("prev_close", "true_range", "rolling_mid", "rolling_atr", "rolling_volume_mean", "rolling_high", "rolling_low", "prior_mid", "prior_high", "prior_low",
         "range_width", "range_position", "lower_touch", "upper_touch", "mid_crossing")


def same(got, want):
    assert set(got) == set(want)
    for key, row in want.items():
        for a, b, name in zip(got[key], row, NAMES):
            assert a == b or (isinstance(b, float) and a == pytest.approx(b, rel=1e-12)), (key, name, a, b)


@pytest.mark.parametrize("w, block, batch, null", [(1, 5, 7, 0.0), (3, 10, 40, 0.1), (20, 1, 1, 0.0), (50, 64, 300, 0.2), (700, 16, 100, 0.0)])
def test_features_equal_a_walk_of_each_history(spark, monkeypatch, w, block, batch, null):
    monkeypatch.setattr(segments, "BLOCK_ROWS", block)
    monkeypatch.setattr(segments, "BATCH_ROWS", batch)
    pick = random.Random(w)
    histories = {k: history(pick, n, gap=pick.choice([3, 60, 4000]), null=null) for k, n in enumerate([1, 2, w, w + 1, 300, 600])}
    bars = table_of(spark, histories)
    found = features.features(bars, w)
    assert found.columns == [*bars.columns, *NAMES] and dict(found.dtypes)["rolling_high"] == "bigint"
    got = {(r.k, r.t): tuple(r[n] for n in NAMES) for r in found.collect()}
    same(got, {(k, t): row for k, h in histories.items() for t, row in by_hand(h, w).items()})


@pytest.mark.parametrize("rows, block", [(1, 3), (7, 10), (40, 1), (133, 64), (700, 5)])
def test_excursions_equal_a_walk(spark, monkeypatch, rows, block):
    monkeypatch.setattr(segments, "BLOCK_ROWS", block)
    pick = random.Random(rows)
    histories = {k: history(pick, n, gap=pick.choice([3, 600])) for k, n in enumerate([1, rows, rows + 1, 400])}
    got = {(r.k, r.t): (r.adverse, r.favourable) for r in features.forward_excursion(table_of(spark, histories), rows).collect()}
    want = {}
    for k, h in histories.items():
        for i, row in enumerate(h):
            ahead = h[i + 1 : i + 1 + rows]
            want[k, row[0]] = (row[4] - min(r[3] for r in ahead), max(r[2] for r in ahead) - row[4]) if len(ahead) == rows else (None, None)
    assert got == want


def test_a_block_has_a_halo_and_a_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(segments, "BLOCK_ROWS", 4000)
    bars = pages.synthetic_market(spark, 3, 40_000)
    plan = segments.block_plan(bars, 300, 200)
    sent = bars.withColumn("__unit", F.col("t") - F.pmod("t", F.lit(DAY))).join(plan, ["k", "__unit"]).withColumn("to", F.explode("__to"))
    counts = sent.groupBy("k", F.col("to.block").alias("b"), F.col("to.own").alias("own"), (F.col("t") - F.pmod("t", F.lit(DAY))).alias("unit")).agg(F.count("*").alias("n")).collect()
    first = {}
    for r in counts:
        if r.own:
            first[r.k, r.b] = min(r.unit, first.get((r.k, r.b), r.unit))
    own, before, after = {}, {}, {}
    for r in counts:
        side = own if r.own else before if r.unit < first[r.k, r.b] else after
        side[r.k, r.b] = side.get((r.k, r.b), 0) + r.n
    last = {k: max(b for kk, b in own if kk == k) for k, _ in own}
    assert sum(own.values()) == 120_000 and len(own) >= 24
    for (k, b), n in own.items():
        assert n <= 4000 + 1440 and (b == last[k] or n >= 4000 - 1440)
        assert (b == 0) == ((k, b) not in before) and 300 <= before.get((k, b), 300) <= 300 + 1440
        assert (b == last[k]) == ((k, b) not in after) and 200 <= after.get((k, b), 200) <= 200 + 1440


def test_rows_without_keys_and_doubles(spark):
    rows = [(1, M * i, 1.5 + i, 2.5 + i, 0.5 + i, 1.25 + i, 3.0) for i in range(5)] + [(None, 0, 1.0, 1.0, 1.0, 1.0, 1.0), (1, None, 1.0, 1.0, 1.0, 1.0, 1.0)]
    bars = spark.createDataFrame(rows, "k long, t long, open double, high double, low double, close double, volume double")
    got = features.features(bars, 2).orderBy("t").collect()
    assert [r.rolling_high for r in got] == [None, 3.5, 4.5, 5.5, 6.5] and [r.rolling_mid for r in got] == [None, 1.75, 2.75, 3.75, 4.75]
    assert features.features(bars.limit(0), 2).count() == 0 and features.forward_excursion(bars.limit(0), 2).count() == 0
