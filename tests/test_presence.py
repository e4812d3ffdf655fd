"""Presence bitmaps against plain sets of keys."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gaps, maintenance
from tidemark.operators.presence import BITS, presence, runs, within_requests

M = 60_000
HOUR = 60 * M


def key_table(spark, keys):
    return spark.createDataFrame(keys, "k long, t long").repartition(3)


def some_keys(pick, n, ks=4, hours=30, off=0.0):
    keys = [(pick.randrange(ks), M * pick.randrange(-5 * 60, hours * 60)) for _ in range(n)]
    keys += [(0, M * m) for m in range(60, 60 * 9)]  # whole words
    keys += pick.choices(keys, k=n // 3)  # repeated
    return [(k, t + 1 if pick.random() < off else t) for k, t in keys]


def some_requests(pick, n=14, ks=5):
    made = []
    for _ in range(n):
        start = M * pick.randrange(-10 * 60, 30 * 60)
        made.append((pick.randrange(ks), start, start + M * pick.choice([0, 1, 59, 60, 61, 700, pick.randrange(2500)])))
    return made + made[:2] + [(0, HOUR, 2 * HOUR - M)]


def test_runs_of_words(spark):
    pick = random.Random(4)
    words = [0, 1, 1 << 59, (1 << 60) - 1, 0b1011] + [pick.getrandbits(60) for _ in range(40)]
    for r in spark.createDataFrame([(w,) for w in words], "w long").select("w", runs(F.col("w")).alias("runs")).collect():
        assert [tuple(x) for x in r.runs] == [(m.start(), m.end() - 1) for m in re.finditer("1+", f"{r.w:060b}"[::-1])]


def test_words_are_made_before_the_one_shuffle(spark):
    rows = key_table(spark, [(1, M * i) for i in range(600)])
    words = presence(a=rows, b=rows.filter("t % 120000 = 0"), c=rows.limit(0))
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan)) == 1
    got = words.collect()
    assert len(got) == 10 and all((r.a, r.c, r.a_rows, r.b_rows) == ((1 << 60) - 1, 0, 60, 30) for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_coverage_equals_sets(spark, seed):
    pick = random.Random(seed)
    tables = [some_keys(pick, n, off=0.02 * (seed == 2)) for n in (700, 60, 60, 600)]
    wanted = some_requests(pick)
    got = gaps.coverage_by_series(spark.createDataFrame(wanted, "k long, start long, stop long"), *[key_table(spark, x) for x in tables]).collect()
    on = [{x for x in keys if x[1] % M == 0} for keys in tables]
    rows, quarantined, excluded, source = on
    want = []
    for k, start, stop in wanted:
        inside = lambda keys: {x for x in keys if x[0] == k and start <= x[1] <= stop}
        off = [sum(x[0] == k and x[1] % M > 0 for x in tables[i]) for i in (0, 3)]
        observed, expected = len(inside(rows)), (stop - start) // M + 1
        row_count = sum(x in inside(rows) for x in tables[0])
        unexpected = len({x for x in rows if x[0] == k}) - observed + off[0]
        mismatch = len({x for x in rows ^ source if x[0] == k}) + sum(off)
        lost = [len(inside(keys) - rows) for keys in (quarantined, excluded)]
        missing = expected - observed
        passed = missing == 0 and row_count == expected and unexpected + mismatch == 0
        want.append((k, start, stop, expected, observed, row_count, row_count - observed, unexpected, mismatch, *lost, missing, missing - sum(lost), passed))
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("step", [M, HOUR])
def test_gaps_equal_sets(spark, step):
    pick = random.Random(step)
    keys = [(k, t // M * step) for k, t in some_keys(pick, 300)] + [(1, 7), (None, 0), (1, None)]
    wanted = [(k, a // M * step, b // M * step) for k, a, b in some_requests(pick)] + [(2, 5 * step, 4 * step)]
    table, asked = key_table(spark, keys), spark.createDataFrame(wanted, "k long, start long, stop long")
    got = {}
    for r in gaps.gap_ranges(asked, table, step).collect():
        assert r.minutes == (r.gap_end - r.gap_start) // step + 1
        got.setdefault((r.k, r.start, r.stop), []).append((r.gap_start, r.gap_end))
    want, listed = {}, []
    for k, start, stop in set(wanted):
        missing = [t for t in range(start, stop + 1, step) if (k, t) not in set(keys)]
        listed += [(k, t) for t in missing]
        for t in missing:
            mine = want.setdefault((k, start, stop), [])
            if mine and mine[-1][1] + step == t:
                mine[-1] = (mine[-1][0], t)
            else:
                mine.append((t, t))
    assert {x: sorted(v) for x, v in got.items()} == want
    assert sorted(map(tuple, gaps.missing_keys(asked, table, step).collect())) == sorted(listed)


def test_exact_coverage_of_words(spark):
    keys = [(1, M * i) for i in range(90)] + [(2, M * i) for i in range(90)] + [(2, 0)] + [(3, M * i) for i in range(89)] + [(3, 89 * M + 1)] + [(4, 0)]
    asked = [(k, 0, 89 * M) for k in (1, 2, 3, 5)]
    got = maintenance.exact_coverage(key_table(spark, keys), spark.createDataFrame(asked, "k long, start long, stop long")).collect()
    assert sorted(map(tuple, got)) == [(1, 90, 90, True), (2, 90, 91, False), (3, 90, 90, False), (4, 0, 1, False), (5, 90, 0, False)]


def test_requests_meet_near_words_only(spark):
    words = presence(a=key_table(spark, [(1, BITS * M * i) for i in range(3000)]))
    asked = spark.createDataFrame([(1, i * 24 * HOUR, (i + 1) * 24 * HOUR - M) for i in range(100)], "k long, start long, stop long")
    met = within_requests(asked, words)
    assert met.count() == 2400 and met.filter("mask <> (1L << 60) - 1").count() == 0
