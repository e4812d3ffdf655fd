"""Ranks, order statistics and digests of whole tables against plain lists."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import digests, ranks, sampling


def test_ranks_over_ranges(spark):
    pick = random.Random(1)
    rows = [(pick.choice([None, 1, 2, 3]), pick.randrange(40), i) for i in range(500)]
    table = spark.createDataFrame(rows, "g long, a long, b long").repartition(7)
    placed, n = ranks.global_rank(table, "a", F.desc("b"))
    got = [r.b for r in placed.orderBy("rank").collect()]
    assert n == 500 and got == [r[2] for r in sorted(rows, key=lambda r: (r[1], -r[2]))]
    assert sorted(r.rank for r in placed.collect()) == list(range(500))
    within = {}
    for r in ranks.rank_within(table, "g", "a", "b").collect():
        within.setdefault(r.g, {})[r.place] = (r.a, r.b)
    for g, places in within.items():
        assert [places[i + 1] for i in range(len(places))] == sorted((a, b) for h, a, b in rows if h == g)


def test_ties_at_the_edges_of_ranges(spark):
    table = spark.createDataFrame([(i // 100, i) for i in range(1000)], "a long, b long").repartition(5)
    placed, _ = ranks.global_rank(table, "a")
    spans = {r.a: (r.lo, r.hi, r.n) for r in placed.groupBy("a").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"), F.countDistinct("rank").alias("n")).collect()}
    assert spans == {a: (100 * a, 100 * a + 99, 100) for a in range(10)}
    assert [r.b for r in sampling.even_rank_sample(table, ["b"], 4).orderBy("b").collect()] == [0, 333, 666, 999]
    assert sampling.even_rank_sample(table.limit(0), ["b"], 4).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_quantiles_equal_sorted_lists(spark, monkeypatch, seed):
    monkeypatch.setattr(ranks, "BUCKETS", 5)
    pick = random.Random(seed)
    values = {"even": [pick.randrange(-(2**40), 2**40) for _ in range(300)], "tied": [7] * 200 + [8] * 3, "one": [-5], None: [1, 2, 3, 2**50]}
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("nothing", None), ("one", None)]
    fractions = (0.0, 0.01, 0.5, 0.985, 0.99, 1.0)
    got = {(r.g, r.fraction): r.v for r in ranks.exact_quantiles(spark.createDataFrame(rows, "g string, v long").repartition(4), "g", "v", fractions).collect()}
    assert got == {(g, f): sorted(vs)[max(math.ceil(f * len(vs)), 1) - 1] for g, vs in values.items() for f in fractions}


def test_digests_tell_multisets_apart(spark):
    def digest(*rows):
        return {r.p: (r.n, tuple(r.digest)) for r in digests.partition_digests(spark.createDataFrame(rows, "p long, a string, b string").repartition(3), ["a", "b"], ["p"]).collect()}

    base = [(1, "x", "y"), (1, "x", "y"), (1, None, "z"), (2, "", None)]
    assert digest(*base) == digest(*reversed(base))
    for other in ([(1, "x", "y"), (1, None, "z"), (1, None, "z"), (2, "", None)], [(1, "x", "y"), (1, "y", "x"), (1, None, "z"), (2, "", None)], [(1, "x", "y"), (1, "x", "y"), (1, "z", None), (2, "", None)]):
        assert digest(*other)[1] != digest(*base)[1] and digest(*other)[2] == digest(*base)[2]
    assert digest((1, None, ""))[1] != digest((1, "", None))[1]


def test_only_partitions_that_differ_are_compared(spark, tmp_path):
    pick = random.Random(3)
    left = [(i % 5, pick.randrange(9), None if i % 11 == 0 else "v") for i in range(200)]
    right = [r for r in left if r[0] != 4] + [(2, 99, "new"), (7, 1, "x")]
    right.remove(next(r for r in right if r[0] == 1))
    tables = []
    for name, rows in (("left", left), ("right", right)):
        spark.createDataFrame(rows, "p long, a long, s string").repartition(3).write.partitionBy("p").parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.schema("a long, s string, p long").parquet(f"{tmp_path}/{name}"))
    assert {r.p for r in digests.differing_partitions(*tables, ["p"]).collect()} == {1, 2, 4, 7}
    got = Counter((r.side, r.p, r.a, r.s) for r in digests.table_difference_by_partition(*tables, ["p"]).collect())
    one, two = Counter(left), Counter(right)
    assert got == Counter({("left", *r): n for r, n in (one - two).items()}) + Counter({("right", *r): n for r, n in (two - one).items()})
    same = digests.table_difference_by_partition(tables[0], tables[0].repartition(2), ["p"])
    assert same.count() == 0 and "Exchange" not in same._jdf.queryExecution().executedPlan().toString().replace("Exchange SinglePartition", "")
