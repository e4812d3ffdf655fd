"""Set operations on keyed tables: overlaps, duplicates, conflicts, segments, lineage, registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.exact import row_digest


def key_overlap(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def union_parents(parents: list[DataFrame]) -> DataFrame:
    """The rows of all fragments with the number of rows that share their key (k, t) as `copies`."""
    both = parents[0]
    for part in parents[1:]:
        both = both.unionByName(part)
    return both.join(both.groupBy("k", "t").agg(F.count("*").alias("copies")), ["k", "t"])


def duplicate_or_conflict(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Repeated keys: `redundant` where all their rows agree in values, else `conflict`."""
    per = rows.withColumn("__d", row_digest(*values)).groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct("__d").alias("versions"))
    return per.filter("n > 1").withColumn("class", F.when(F.col("versions") == 1, "redundant").otherwise("conflict"))


def partition_gap(required: DataFrame, observed: DataFrame, *keys: str) -> DataFrame:
    """Required partitions that aren't observed."""
    return required.select(*keys).distinct().join(observed.select(*keys).distinct(), list(keys), "left_anti")


def source_overlap(rows: DataFrame) -> DataFrame:
    """Pairs of sources (a before b) that share an instrument and month, from (source, k, month)."""
    one = rows.select("source", "k", "month").distinct()
    return one.withColumnRenamed("source", "a").join(one.withColumnRenamed("source", "b"), ["k", "month"]).filter("a < b")


def topology(rows: DataFrame) -> DataFrame:
    """(kind, month, instruments): the sorted set of instruments of each kind and month."""
    return rows.select("kind", "month", "k").distinct().groupBy("kind", "month").agg(F.sort_array(F.collect_list("k")).alias("instruments"))


def topology_segments(monthly: DataFrame) -> DataFrame:
    """Stretches of consecutive months (numbers) with the same instruments, by kind."""
    line = Window.partitionBy("kind").orderBy("month")
    same = (F.col("month") == F.lag("month").over(line) + 1) & (F.col("instruments") == F.lag("instruments").over(line))
    numbered = monthly.withColumn("new", (~F.coalesce(same, F.lit(False))).cast("int")).withColumn("segment", F.sum("new").over(line))
    return numbered.groupBy("kind", "segment").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count("*").alias("months"), F.first(F.size("instruments")).alias("instruments"))


def bounds_ambiguous(files: DataFrame) -> DataFrame:
    """Files (part, file, first_k, first_t, last_k, last_t) whose key range begins at or before where one before it ends."""
    line = Window.partitionBy("part").orderBy("first_k", "first_t", "file").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.struct("last_k", "last_t")).over(line)
    first = F.struct(F.col("first_k").alias("last_k"), F.col("first_t").alias("last_t"))
    return files.withColumn("ambiguous", F.coalesce(reach >= first, F.lit(False)))


def strict_key_order(rows: DataFrame, place: str, by: str) -> DataFrame:
    """Of each group `by`: rows whose (k, t) isn't above the row before them in order of place."""
    line = Window.partitionBy(by).orderBy(place)
    key = F.struct("k", "t")
    marked = rows.withColumn("bad", F.coalesce(key <= F.lag(key).over(line), F.lit(False)))
    return marked.groupBy(by).agg(F.count("*").alias("rows"), F.count(F.when(F.col("bad"), 1)).alias("violations")).withColumn("ordered", F.col("violations") == 0)


def lineage_closure(parents: DataFrame) -> DataFrame:
    """(child, ancestor) of all levels from (child, parent), by doubling the reach; a cycle shows as child = ancestor.

    It ends when nothing is added, after as many rounds as the longest path's length has binary digits.
    """
    reach = parents.select("child", F.col("parent").alias("ancestor")).distinct()
    while True:
        further = reach.join(reach.select(F.col("child").alias("ancestor"), F.col("ancestor").alias("up")), "ancestor").select("child", F.col("up").alias("ancestor"))
        grown = reach.unionByName(further).distinct().checkpoint()
        if grown.count() == reach.count():
            return grown
        reach = grown


def register(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Each entry (id, binding, parent) of a batch as new, same, conflict or orphan against a catalog.

    A null binding is a binding, equal to null alone. An id that the catalog has with several bindings conflicts with all.
    """
    held = F.collect_set(F.struct(F.col("binding").alias("bound")))  # of one id
    known = existing.select("id", "binding").distinct().groupBy("id").agg(held.alias("held"))
    parents = existing.select(F.col("id").alias("parent")).unionByName(batch.select(F.col("id").alias("parent"))).distinct().withColumn("has_parent", F.lit(True))
    met = batch.join(known, "id", "left").join(parents, "parent", "left")
    orphan = F.col("parent").isNotNull() & F.col("has_parent").isNull()
    same = (F.size("held") == 1) & F.get("held", F.lit(0))["bound"].eqNullSafe(F.col("binding"))
    state = F.when(orphan, "orphan").when(F.col("held").isNull(), "new").when(same, "same").otherwise("conflict")
    return met.select("id", "binding", "parent", state.alias("state"))
