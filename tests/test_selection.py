"""Selection of files through the manifest: what is refused, and how many files are read."""

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.operators import selection as S
from tidemark.sources import canonical

M = 60_000
SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in ("k", "t", "close")])
JAN, FEB = 1_767_225_600_000, 1_769_904_000_000


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Datasets of 16 instruments: a (January, early minutes), b (January, later ones), c (February), d (a rewritten), e (touches b's last minute)."""
    folder = tmp_path_factory.mktemp("store")
    spans = {"a": (JAN, 0, 50), "b": (JAN, 50, 100), "c": (FEB, 0, 40), "d": (JAN, 0, 50), "e": (JAN, 99, 120)}
    manifests = []
    for name, (start, first, last) in spans.items():
        rows = spark.range(16 * (last - first)).select((F.col("id") % 16 + 1).alias("k"), (F.lit(start) + (F.col("id") / 16).cast("long") * M + first * M).alias("t"), F.col("id").alias("close"))
        canonical.write_canonical(rows, f"{folder}/{name}")
        manifests.append(S.file_manifest(canonical.read_canonical(spark, f"{folder}/{name}", SCHEMA), name))
    manifest = manifests[0]
    for other in manifests[1:]:
        manifest = manifest.unionByName(other)
    manifest.write.parquet(f"{folder}/manifest")
    lineage = spark.createDataFrame([("d", "x"), ("x", "a"), ("e", "b")], "child string, parent string")
    datasets = spark.createDataFrame([(x,) for x in "abcdex"], "id string")
    return spark.read.parquet(f"{folder}/manifest"), lineage, datasets


def refused(store, selected, start, end, ids=None):
    with pytest.raises(S.SelectionRefused) as said:
        S.read_selection(*store, selected, SCHEMA, start, end, ids)
    return [(f.fault, f.what) for f in said.value.faults]


def test_rows_of_a_selection(spark, store):
    got = S.read_selection(*store, ["a", "b", "c"], SCHEMA, JAN + 40 * M, FEB + 9 * M, ids=[3, 11])
    assert got.count() == 2 * (60 + 10) and {r.k for r in got.select("k").distinct().collect()} == {3, 11}
    one = S.read_selection(*store, ["a", "b"], SCHEMA, JAN + 60 * M, JAN + 61 * M)
    assert one.count() == 32 and len(one.inputFiles()) == 8  # those of b alone: a ends before


def test_files_that_cannot_share_keys_are_not_read(spark, store):
    manifest = store[0]
    apart = S.select_files(manifest.filter("dataset in ('a', 'c')"), JAN, FEB + 100 * M)
    keys, read = S.shared_keys(spark, apart, SCHEMA)
    assert read == 0 and keys.count() == 0
    doubt = S.select_files(manifest.filter("dataset in ('a', 'b', 'c')"), JAN, FEB + 100 * M, ids=[3])
    assert S.shared_keys(spark, doubt, SCHEMA)[1] == 2  # a and b have the same instruments at different minutes, c is another month
    assert S.shared_keys(spark, doubt, SCHEMA)[0].count() == 0


def test_what_is_refused(store):
    assert refused(store, ["a", "zz"], JAN, JAN + M) == [("not_registered", "zz")]
    assert refused(store, ["a", "d"], JAN, JAN + M) == [("ancestor_selected", "a of d")]
    assert refused(store, ["a"], JAN, FEB, ids=[1, 9, 2]) == [("missing_partition", f"year=2026/month=02/bucket={b:02d}") for b in (1, 2)]
    manifest, lineage, datasets = store
    faults = refused((manifest, lineage.filter("child <> 'e'"), datasets), ["b", "e"], JAN, JAN + 200 * M)
    assert len(faults) == 16 and set(f[0] for f in faults) == {"shared_key"} and ("shared_key", f"5,{JAN + 99 * M}") in faults
    assert refused((manifest, lineage, datasets.filter("id <> 'x'")), ["d"], JAN, JAN + M) == [("missing_parent", "x of d")]
    circle = lineage.unionByName(lineage.sparkSession.createDataFrame([("a", "d")], lineage.schema))
    assert refused((manifest, circle, datasets), ["d", "b"], JAN, JAN + M) == [("cycle", x) for x in "adx"]


def test_clusters_are_swept(spark):
    rows = [("p", (1, 0), (1, 5)), ("q", (1, 6), (1, 9)), ("r", (1, 9), (2, 0)), ("s", (1, 7), (1, 8)), ("t", (2, 1), (2, 2))]
    files = spark.createDataFrame([(f, 1, 1, 1, a, b) for f, a, b in rows], "file string, year long, month long, bucket long, first struct<k:long,t:long>, last struct<k:long,t:long>")
    assert {r.file: (r.cluster, r.of_cluster) for r in S.overlap_groups(files).collect()} == {"p": (1, 1), "q": (2, 3), "s": (2, 3), "r": (2, 3), "t": (3, 1)}


def test_ancestors_of_cycles_and_diamonds(spark):
    lineage = spark.createDataFrame([(5, 4), (5, 3), (4, 2), (3, 2), (2, 1), (8, 9), (9, 8), (7, 8)], "child long, parent long")
    got = {(r.id, r.ancestor) for r in S.ancestors(lineage, spark.createDataFrame([(5,), (7,), (8,), (1,)], "id long")).collect()}
    assert got == {(5, 4), (5, 3), (5, 2), (5, 1), (7, 8), (7, 9), (8, 9), (8, 8)}
