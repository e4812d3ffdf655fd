"""Landing pages twice, in parts and after restarts; compaction of some partitions."""

import json

from pyspark.sql import functions as F, types as T

from tidemark.operators import maintenance
from tidemark.sources import canonical
from tidemark.streaming.landing import land

M = 60_000
JAN, FEB = 1_767_225_600_000, 1_769_904_000_000
PAGE = "json string"


def page(k, rows):
    return (json.dumps({"k": k, "kind": "trade", "rows": [[str(t), *map(str, x)] for t, *x in rows]}),)


def bars(k, start, first, last, close=100.5):
    return page(k, [(start + i * M, 100, 101, 99, close, 7, 700) for i in range(last, first, -1)])


def test_pages_land_once(spark, tmp_path):
    pages, path = f"{tmp_path}/pages", f"{tmp_path}/table"
    stream = lambda: spark.readStream.schema(PAGE).option("maxFilesPerTrigger", 1).parquet(pages)
    put = lambda *rows: spark.createDataFrame(rows, PAGE).coalesce(1).write.mode("append").parquet(pages)
    stored = lambda: sorted((r.k, r.t, r.close) for r in spark.read.parquet(f"{path}/rows").collect())
    put(bars(1, JAN, 0, 30), bars(2, JAN, 0, 10))
    put(bars(1, JAN, 20, 50), page(3, [(JAN, 100, 90, 99, 100, 1, 1), (JAN + M, "1e400", 2, 1, 1, 1, 1), (JAN + 2 * M, 5, 5, 5, 5, -1, 1)]))  # overlaps; all of 3 is broken
    land(stream(), path, 200)
    want = [(1, JAN + i * M, 10_050_000_000) for i in range(1, 51)] + [(2, JAN + i * M, 10_050_000_000) for i in range(1, 11)]
    assert stored() == want
    assert sorted(r.reason for r in spark.read.parquet(f"{path}/quarantine").collect()) == ["low_exceeds_high", "rejected", "rejected"]
    files = {r.f for r in spark.read.parquet(f"{path}/rows").filter("month = 1").select(F.input_file_name().alias("f")).distinct().collect()}
    land(stream(), path, 200)  # a restart without new pages
    assert stored() == want and files == {r.f for r in spark.read.parquet(f"{path}/rows").filter("month = 1").select(F.input_file_name().alias("f")).distinct().collect()}
    put(bars(1, JAN, 0, 50, close=100.25), bars(4, FEB, 0, 5))  # the same keys landed again, with other closes, and a new month
    land(stream(), path, 200)
    assert stored() == want + [(4, FEB + i * M, 10_050_000_000) for i in range(1, 6)]
    (tmp_path / "table" / "checkpoint").rename(tmp_path / "lost")  # offsets lost: everything is landed a second time
    land(stream(), path, 200)
    assert stored() == want + [(4, FEB + i * M, 10_050_000_000) for i in range(1, 6)]


def test_bins_of_files(spark):
    rows = [(1, "a", 40, 0), (1, "b", 40, 5), (1, "c", 40, 9), (1, "d", 200, 7), (2, "e", 100, 0), (2, "f", 110, 1), (3, "g", 10, 0)]
    files = spark.createDataFrame(rows, "bucket long, file string, size long, first long").selectExpr("2026 as year", "1 as month", "*")
    got = {r.file: (r.bin, r.files, r.bins, r.worthwhile) for r in maintenance.compaction_bins(files, 100).collect()}
    assert got == {"a": (0, 4, 3, True), "b": (0, 4, 3, True), "c": (1, 4, 3, True), "d": (-1, 4, 3, True), "e": (0, 2, 2, False), "f": (2, 2, 2, False), "g": (0, 1, 1, False)}


def test_partitions_that_cannot_gain_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("k", "t")])
    rows = canonical.partition_columns(spark.range(4000).select((F.col("id") % 4 + 1).alias("k"), (F.lit(JAN) + F.col("id") * M * 20).alias("t")))
    for part in range(6):
        rows.filter((F.col("bucket") < 3) & (F.col("t") / M % 6 == part) | (F.col("bucket") >= 3) & F.lit(part == 0)).repartition(*canonical.PARTITIONS).write.partitionBy(*canonical.PARTITIONS).mode("append").parquet(path)
    listed = lambda: {str(p.relative_to(path)) for p in (tmp_path / "table").rglob("*.parquet")}
    before = listed()
    plan = maintenance.compact_partitions(canonical.read_canonical(spark, path, schema), path)
    after = listed()
    assert {f for f in before if "bucket=3" in f or "bucket=4" in f} == {f for f in after if "bucket=3" in f or "bucket=4" in f}
    assert len([f for f in after if "bucket=2" in f]) == len({f.rsplit("/", 1)[0] for f in after if "bucket=2" in f})
    assert {(r.bucket, r.worthwhile) for r in plan.collect() if r.files > 1} == {(1, True), (2, True)}
    stored = spark.read.parquet(path).select("k", "t", *canonical.PARTITIONS)
    assert stored.exceptAll(rows.select(*stored.columns)).count() == 0 and stored.count() == 4000
    again = maintenance.compact_partitions(canonical.read_canonical(spark, path, schema), path)
    assert not any(r.worthwhile for r in again.collect()) and listed() == after
