"""Selection of stored files through their manifest: what may be read together, and what is refused without reading rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tidemark.functions.exact import stable_bucket
from tidemark.sources.canonical import PARTITIONS, months_between
from tidemark.sources.shared import checkpoints

BUCKETS = 8
#: Levels of parents that a selection may have.
MOST_LEVELS = 90


class SelectionRefused(ValueError):
    """Files that can't be read as one table; its faults say why."""

    def __init__(self, faults: list):
        super().__init__("; ".join(f"{f.fault}: {f.what}" for f in faults))
        self.faults = faults


def file_manifest(table: DataFrame, dataset: str) -> DataFrame:
    """(dataset, file, year, month, bucket, rows, first, last, min_k, max_k, min_t, max_t) of each file of a stored table.

    first and last are the least and greatest (k, t), as a file sorted by them begins and ends.
    """
    key = F.struct("k", "t")
    return table.groupBy(F.lit(dataset).alias("dataset"), F.col("_metadata.file_path").alias("file"), *PARTITIONS).agg(
        F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"),
        F.min("k").alias("min_k"), F.max("k").alias("max_k"), F.min("t").alias("min_t"), F.max("t").alias("max_t"))


def required_partitions(spark: SparkSession, start_ms: int, end_ms: int, ids: list[int] | None = None) -> DataFrame:
    """(year, month, bucket) that a selection of an inclusive range and the listed instruments (None: all) needs."""
    months = spark.createDataFrame(months_between(start_ms, end_ms), "year long, month long")
    if ids is None:
        return months.withColumn("bucket", F.explode(F.array(*[F.lit(b).cast("long") for b in range(BUCKETS)])))
    wanted = spark.createDataFrame([(i,) for i in ids], "k long").select(stable_bucket(F.col("k")).cast("long").alias("bucket")).distinct()
    return months.join(wanted, how="cross")  # a row for each month and one of eight buckets


def _within(start_ms: int, end_ms: int, ids: list[int] | None) -> Column:
    meets = (F.col("max_t") >= start_ms) & (F.col("min_t") <= end_ms)
    if ids is None:
        return meets
    listed = F.array(*[F.lit(i).cast("long") for i in sorted(set(ids))])
    return meets & F.exists(listed, lambda i: (i >= F.col("min_k")) & (i <= F.col("max_k")) & (stable_bucket(i) == F.col("bucket")))


def overlap_groups(files: DataFrame) -> DataFrame:
    """files with `cluster`: by partition, files whose key ranges are connected by overlaps share one.

    A sweep over the files of a partition in order of their first keys: one that begins after everything before it has
    ended starts a new cluster. Files alone in theirs can't share a key with another.
    """
    line = Window.partitionBy(*PARTITIONS).orderBy("first", "last", "file")
    reach = F.max("last").over(line.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("first") > reach, F.lit(True)).cast("int")
    numbered = files.withColumn("__fresh", fresh).withColumn("cluster", F.sum("__fresh").over(line))
    whole = Window.partitionBy(*PARTITIONS, "cluster")
    return numbered.withColumn("of_cluster", F.count("*").over(whole)).drop("__fresh")


def ancestors(lineage: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, ancestor) of the given ids by a recursive query over lineage (child, parent), MOST_LEVELS up at most.

    A path ends where it meets itself, so an id in a cycle is its own ancestor. The result is kept in the shared folder.
    """
    checkpoints(lineage.sparkSession)
    found = lineage.sparkSession.sql(
        f"""with recursive up(id, ancestor, path) max recursion level {MOST_LEVELS + 10} as (
              select i.id, l.parent, array(i.id, l.parent) from {{ids}} i join {{lineage}} l on l.child = i.id
              union all
              select u.id, l.parent, array_append(u.path, l.parent) from up u join {{lineage}} l on l.child = u.ancestor
              where not array_contains(slice(u.path, 2, {MOST_LEVELS}), l.parent) and size(u.path) <= {MOST_LEVELS})
            select distinct id, ancestor from up""", ids=ids.select("id").distinct(), lineage=lineage.select("child", "parent").distinct().checkpoint())
    return found.checkpoint()


def lineage_faults(lineage: DataFrame, datasets: DataFrame, selected: DataFrame) -> DataFrame:
    """(fault, what) of a selection: ids (id) that aren't among the registered datasets (id), parents of the selected or of their
    ancestors that aren't, cycles among those, and pairs of an ancestor and its child that are both selected."""
    chosen = selected.select("id").distinct()
    above = ancestors(lineage, chosen)
    reached = chosen.unionByName(above.select(F.col("ancestor").alias("id"))).distinct()
    edges = lineage.select("child", "parent").distinct().join(reached.withColumnRenamed("id", "child"), "child", "left_semi")
    known = datasets.select("id").distinct()
    text = lambda c: F.col(c).cast("string")
    rows = [
        chosen.join(known, "id", "left_anti").select(F.lit("not_registered").alias("fault"), text("id").alias("what")),
        edges.join(known.withColumnRenamed("id", "parent"), "parent", "left_anti").select(F.lit("missing_parent").alias("fault"), F.concat_ws(" of ", text("parent"), text("child")).alias("what")),
        ancestors(edges, reached).filter("id = ancestor").select(F.lit("cycle").alias("fault"), text("id").alias("what")),
        above.filter("id <> ancestor").join(chosen.withColumnRenamed("id", "ancestor"), "ancestor", "left_semi").select(
            F.lit("ancestor_selected").alias("fault"), F.concat_ws(" of ", text("ancestor"), text("id")).alias("what"))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


def partition_faults(manifest: DataFrame, start_ms: int, end_ms: int, ids: list[int] | None = None) -> DataFrame:
    """(fault, what) of each month and bucket that the selection needs and no file is in."""
    there = manifest.select(*[F.col(c).cast("long").alias(c) for c in PARTITIONS]).distinct()
    lacks = required_partitions(manifest.sparkSession, start_ms, end_ms, ids).join(there, list(PARTITIONS), "left_anti")
    what = F.format_string("year=%04d/month=%02d/bucket=%02d", *PARTITIONS)
    return lacks.select(F.lit("missing_partition").alias("fault"), what.alias("what"))


def select_files(manifest: DataFrame, start_ms: int, end_ms: int, ids: list[int] | None = None) -> DataFrame:
    """The files of the manifest that may hold rows of the range and instruments, with their clusters of overlapping ones."""
    needed = required_partitions(manifest.sparkSession, start_ms, end_ms, ids)
    typed = manifest.withColumns({c: F.col(c).cast("long") for c in PARTITIONS})
    return overlap_groups(typed.join(needed, list(PARTITIONS), "left_semi").filter(_within(start_ms, end_ms, ids)))


def shared_keys(spark: SparkSession, files: DataFrame, schema: T.StructType) -> tuple[DataFrame, int]:
    """(k, t, n) of keys that more than one row of the selected files has, and how many files were read for that.

    Only files that share a cluster with another are read, and of them the key columns; where there are none, nothing is.
    """
    paths = [r.file for r in files.filter("of_cluster > 1").select("file").collect()]  # names of the files in doubt
    keys = T.StructType([f for f in schema.fields if f.name in ("k", "t")])
    rows = spark.read.schema(keys).parquet(*paths) if paths else spark.createDataFrame([], keys)
    return rows.groupBy("k", "t").agg(F.count("*").alias("n")).filter("n > 1"), len(paths)


def read_selection(manifest: DataFrame, lineage: DataFrame, datasets: DataFrame, selected: list[str], schema: T.StructType,
                   start_ms: int, end_ms: int, ids: list[int] | None = None) -> DataFrame:
    """Exactly the rows of the range and instruments that the selected datasets have, from the files that may hold them.

    Refused with SelectionRefused, before rows are read: ids that aren't registered, parents that lack, cycles, an ancestor
    beside its child, a month or bucket that no selected file is in; and, where key ranges of files overlap, keys that
    two rows share.
    """
    spark = manifest.sparkSession
    chosen = spark.createDataFrame([(s,) for s in selected], "id string")
    mine = manifest.join(chosen.withColumnRenamed("id", "dataset"), "dataset", "left_semi")
    faults = lineage_faults(lineage, datasets, chosen).unionByName(partition_faults(mine, start_ms, end_ms, ids))
    files = select_files(mine, start_ms, end_ms, ids)
    if found := faults.orderBy("fault", "what").limit(100).collect():
        raise SelectionRefused(found)
    double, _ = shared_keys(spark, files, schema)
    if found := double.select(F.lit("shared_key").alias("fault"), F.concat_ws(",", "k", "t").alias("what")).limit(100).collect():
        raise SelectionRefused(found)
    paths = [r.file for r in files.select("file").collect()]
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    rows = rows.filter(F.col("t").between(start_ms, end_ms))
    return rows if ids is None else rows.filter(F.col("k").isin(ids))
