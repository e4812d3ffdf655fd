"""Compaction and repair of partitioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.exact import stable_bucket
from tidemark.operators.presence import presence, within_requests
from tidemark.sources import canonical
from tidemark.sources.shared import checkpoints

# Fixed values of the layout.
TARGET_BYTES, ROW_GROUP = 16 * 1024 * 1024, 128_000


def rows_per_file(sample_rows: Column, sample_bytes: Column, target: int = TARGET_BYTES, group: int = ROW_GROUP) -> Column:
    """Rows that fill a file of the target size at the sample's bytes for each row, up to a whole row group."""
    return F.ceil(F.lit(target) * sample_rows / sample_bytes / group) * group


def file_size_class(size: Column, target: int = TARGET_BYTES) -> Column:
    return F.when(size * 100 < 80 * target, "tail").when(size * 100 <= 120 * target, "target").otherwise("oversized")


def compaction_plan(files: DataFrame, most_rows: int) -> DataFrame:
    """(part, files, rows, new_files, worthwhile) of file statistics (part, rows): only the last new file is short."""
    sums = files.groupBy("part").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))
    made = sums.withColumn("new_files", F.ceil(F.col("rows") / most_rows))
    return made.withColumn("worthwhile", F.col("new_files") < F.col("files"))


def compact(table: DataFrame, path: str, most_rows: int, by: list[str]) -> None:
    """Rewrite a table as files of at most most_rows rows, sorted by (k, t) in each partition `by`."""
    table.repartition(*[F.col(c) for c in by]).sortWithinPartitions(*by, "k", "t").write.partitionBy(*by).option("maxRecordsPerFile", most_rows).parquet(path)


def compact_fragments(rows: DataFrame, folder: str, most_rows: int) -> DataFrame:
    """Write rows (k, t, fragment, ...) as one dataset for each fragment under folder/fragments, compact the union of
    what is stored into months and buckets under folder/compacted, and read that back."""
    spark, by = rows.sparkSession, [*canonical.PARTITIONS]
    rows.repartition(F.col("fragment"), stable_bucket(F.col("k"))).sortWithinPartitions("fragment", "k", "t").write.partitionBy("fragment").parquet(f"{folder}/fragments")
    union = canonical.partition_columns(spark.read.schema(rows.schema).parquet(f"{folder}/fragments"))
    compact(union, f"{folder}/compacted", most_rows, by)
    return spark.read.schema(union.schema).parquet(f"{folder}/compacted").drop(*by)


def files_fall(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """(by, files_before, files_after, falls) of a stored table and its compaction: one that doesn't lower the number of
    files of a partition is refused there. Partitions that only one side has count no files on the other and don't fall."""
    counts = [df.groupBy(*by).agg(F.countDistinct("_metadata.file_path").alias(name)) for df, name in ((before, "files_before"), (after, "files_after"))]
    met = counts[0].join(counts[1], by, "full_outer").select(*by, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("files_before", "files_after")])
    return met.withColumn("falls", (F.col("files_after") > 0) & (F.col("files_after") < F.col("files_before")))


def compaction_bins(files: DataFrame, target: int = TARGET_BYTES) -> DataFrame:
    """files (by, file, size, first) with `bin`, `files` and `bins` of their partition, and whether it is worthwhile.

    Files of a partition are packed into bins in order of their first keys, so that a bin's keys are near each other: one
    that is full (120% of the target, or more) stays alone, the others fill bins of about the target. Worthwhile: there are
    fewer bins than files.
    """
    part = [*canonical.PARTITIONS]
    line = Window.partitionBy(*part).orderBy("first", "file")
    small = F.col("size") * 100 < 120 * target
    packed = files.withColumns({"__upto": F.coalesce(F.sum(F.when(small, F.col("size"))).over(line), F.lit(0)), "__large": F.count(F.when(~small, 1)).over(line)})
    run = F.when(small, F.floor((F.col("__upto") - 1) / target)).otherwise(-F.col("__large")).cast("long")
    packed = packed.withColumn("bin", run).drop("__upto", "__large")
    whole = Window.partitionBy(*part)
    packed = packed.withColumns({"files": F.count("*").over(whole), "bins": F.size(F.collect_set("bin").over(whole)).cast("long")})  # numbers of one partition's bins
    return packed.withColumn("worthwhile", F.col("bins") < F.col("files"))


def file_sizes(table: DataFrame) -> DataFrame:
    """(year, month, bucket, file, size, first) of each file of a stored canonical table; first is its least (k, t)."""
    meta = table.select(*canonical.PARTITIONS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.struct("k", "t").alias("key"))
    return meta.groupBy(*canonical.PARTITIONS, "file").agg(F.first("size").alias("size"), F.min("key").alias("first"))


def compact_partitions(table: DataFrame, path: str, target: int = TARGET_BYTES) -> DataFrame:
    """Rewrite the month and bucket partitions of the canonical table stored at `path` that have fewer bins than files.

    `table` reads that path. Only those partitions are read, and replaced at once by dynamic partition overwrite; every bin is
    one task's sorted file, so a partition of many bins is many tasks' work. The others keep their files. A partition
    whose files wouldn't fall is refused. Returns the plan, a row for each partition: (year, month, bucket, files,
    bins, worthwhile); it is kept in the shared folder, as the files that it names are gone then.
    """
    spark, part = table.sparkSession, [*canonical.PARTITIONS]
    checkpoints(spark)
    bins = compaction_bins(file_sizes(table), target).checkpoint()
    plan = bins.groupBy(*part).agg(F.first("files").alias("files"), F.first("bins").alias("bins"), F.first("worthwhile").alias("worthwhile")).checkpoint()
    chosen = bins.filter("worthwhile").select("file", "bin")
    if not chosen.isEmpty():
        paths = [r.file for r in chosen.select("file").collect()]  # names of files, not their rows
        rows = spark.read.option("basePath", path).schema(table.schema).parquet(*paths).withColumn("__file", F.col("_metadata.file_path"))
        met = rows.join(chosen.withColumnRenamed("file", "__file"), "__file").drop("__file")
        dealt = met.repartition(*part, "bin").sortWithinPartitions(*part, "bin", "k", "t").drop("bin")
        dealt.write.partitionBy(*part).mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", canonical.CODEC).parquet(path)
    return plan


def plan_gap_repairs(gaps: DataFrame, explained: DataFrame, page_minutes: int, most_minutes: int) -> DataFrame:
    """One task for each gap (k, gap_start, gap_end, minutes) with pages and size class; gaps that hold an explained
    missing key (k, t) don't qualify.

    Gaps and keys are sorted together once by (k, t): a gap holds a key if the next one from its start on is inside.
    Gaps may overlap; repeated ones stay repeated.
    """
    starts = gaps.select("k", F.col("gap_start").alias("t"), F.struct("gap_end", "minutes").alias("__gap"), F.lit(None).cast("long").alias("__key"), F.lit(0).alias("__side"))
    keys = explained.select("k", "t", F.lit(None).cast(starts.schema["__gap"].dataType).alias("__gap"), F.col("t").alias("__key"), F.lit(1).alias("__side"))
    backwards = Window.partitionBy("k").orderBy(F.col("t").desc(), F.col("__side").desc()).rowsBetween(Window.unboundedPreceding, 0)
    met = starts.unionByName(keys).withColumn("__next", F.last("__key", ignorenulls=True).over(backwards)).filter("__side = 0")
    tasks = met.select("k", F.col("t").alias("gap_start"), "__gap.gap_end", "__gap.minutes", "__next").filter("__next is null or __next > gap_end").drop("__next")
    return tasks.withColumn("pages", F.ceil(F.col("minutes") / page_minutes)).withColumn("within_limit", F.col("minutes") <= most_minutes)


def apply_repair(parent: DataFrame, repair: DataFrame) -> DataFrame:
    """Parent and repair rows as one table with their origin; keys that both have are marked as overlap."""
    both = parent.select("k", "t", "close", F.lit("parent").alias("origin")).unionByName(repair.select("k", "t", "close", F.lit("repair").alias("origin")))
    shared = both.groupBy("k", "t").agg((F.countDistinct("origin") > 1).alias("overlap"))
    return both.join(shared, ["k", "t"])


def repair_outcome(tasks: DataFrame, returned: DataFrame) -> DataFrame:
    """(k, gap_start, minutes, returned, missing, passed) of repair tasks and the rows (k, t) that came back.

    Both are sorted together once by (k, t); a task's rows are the running count at its end less that before its start.
    Tasks may overlap; equal ones count once, repeated rows too.
    """
    gap = F.struct("gap_start", "gap_end", "minutes")
    begins = tasks.select("k", F.col("gap_start").alias("t"), gap.alias("__gap"), F.lit(0).alias("__side"))
    ends = tasks.select("k", F.col("gap_end").alias("t"), gap.alias("__gap"), F.lit(2).alias("__side"))
    rows = returned.select("k", "t").distinct().select("k", "t", F.lit(None).cast(begins.schema["__gap"].dataType).alias("__gap"), F.lit(1).alias("__side"))
    line = Window.partitionBy("k").orderBy("t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    counted = begins.unionByName(ends).unionByName(rows).withColumn("__run", F.count(F.when(F.col("__side") == 1, 1)).over(line)).filter("__side <> 1")
    met = counted.groupBy("k", "__gap").agg((F.max("__run") - F.min("__run")).alias("returned"))
    return met.select("k", "__gap.gap_start", "__gap.minutes", "returned", (F.col("__gap.minutes") - F.col("returned")).alias("missing"), (F.col("__gap.minutes") == F.col("returned")).alias("passed"))


def exact_coverage(table: DataFrame, requests: DataFrame, step: int = 60_000) -> DataFrame:
    """(k, expected, n, exact) of rows (k, t) and one request (k, start, stop; both inclusive) for each k.

    exact: every requested minute once and nothing else. Rows without a request expect nothing, requests without rows have n = 0.
    Counted in presence words, which are a sixtieth of the rows.
    """
    words = presence(step, row=table)
    inside = within_requests(requests, words, step).groupBy("k").agg(F.sum(F.bit_count(F.col("row").bitwiseAND(F.col("mask")))).alias("inside"))
    sums = words.groupBy("k").agg(F.sum(F.col("row_rows") + F.col("row_off")).alias("n"))
    met = sums.join(requests.select("k", "start", "stop"), "k", "full_outer").join(inside, "k", "left")
    expected = F.coalesce(F.floor((F.col("stop") - F.col("start")) / step) + 1, F.lit(0))
    exact = (F.col("n") == expected) & (F.col("inside") == expected)
    return met.select("k", expected.alias("expected"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(exact, F.lit(False)).alias("exact"))


def repair_classification(coverage: DataFrame) -> DataFrame:
    """What may be done for each audited series: nothing, a repair of gaps without data, or neither and why.

    Series whose `kind` is funding have a repair of their own and are kept apart.
    """
    kind = (F.when(F.col("kind") == "funding", "funding_separate").when(F.col("passed"), "not_blocked").when(F.col("duplicates") + F.col("unexpected") > 0, "ineligible_key_defects")
            .when(F.col("quarantined_missing") > 0, "ineligible_quarantined").when(F.col("excluded_missing") > 0, "ineligible_excluded").otherwise("eligible"))
    return coverage.withColumn("class", kind)
