"""Missing minutes: gap ranges, their topology, coverage of requested series, tiling of pages, interval sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.times import MINUTE
from tidemark.operators.presence import FULL, presence, runs, within_requests
from tidemark.sources.shared import checkpoints


def gap_ranges(requests: DataFrame, rows: DataFrame, step: int = MINUTE) -> DataFrame:
    """Maximal missing runs (k, start, stop, gap_start, gap_end, minutes) of requested series (k, start, stop; both inclusive).

    Leading, internal and trailing runs, and the whole series where nothing is observed. Rows become presence words
    before they are shuffled; the runs of ones in the words of a request are stitched over words, and what is between
    two is a gap, so missing keys are never listed. Requests are whole steps and may overlap; repeated ones count once.
    Rows between two steps fill none.
    """
    wanted = requests.select("k", "start", "stop").distinct()
    seen = within_requests(wanted, presence(step, seen=rows), step)
    seen = seen.select("k", "start", "stop", "word", F.col("seen").bitwiseAND(F.col("mask")).alias("bits")).filter("bits <> 0")
    run = seen.select("k", "start", "stop", "word", F.explode(runs(F.col("bits"))).alias("r"))
    run = run.select("k", "start", "stop", (F.col("word") + F.col("r.first") * F.lit(step)).alias("first"), (F.col("word") + F.col("r.last") * F.lit(step)).alias("last"))
    line = Window.partitionBy("k", "start", "stop").orderBy("first")
    inner = run.select("k", "start", "stop", "first", F.coalesce(F.lag("last").over(line), F.col("start") - step).alias("before"))
    inner = inner.filter(F.col("first") - F.col("before") > step).select("k", "start", "stop", (F.col("before") + step).alias("gap_start"), (F.col("first") - step).alias("gap_end"))
    last = run.groupBy("k", "start", "stop").agg(F.max("last").alias("last"))
    tail = wanted.join(last, ["k", "start", "stop"], "left").select(
        "k", "start", "stop", F.coalesce(F.col("last") + step, F.col("start")).alias("gap_start"), F.col("stop").alias("gap_end")).filter("gap_start <= gap_end")
    both = inner.unionByName(tail)
    return both.withColumn("minutes", ((F.col("gap_end") - F.col("gap_start")) / step + 1).cast("long"))


def gap_topology(requests: DataFrame, rows: DataFrame, step: int = MINUTE) -> DataFrame:
    """Leading, internal, trailing and fully absent minutes and ranges of each series; they sum to `missing`."""
    gaps = gap_ranges(requests, rows, step)
    absent = (F.col("gap_start") == F.col("start")) & (F.col("gap_end") == F.col("stop"))
    leading = ~absent & (F.col("gap_start") == F.col("start"))
    trailing = ~absent & (F.col("gap_end") == F.col("stop"))
    internal = ~absent & ~leading & ~trailing
    sums = {"absent": absent, "leading": leading, "trailing": trailing, "internal": internal}
    columns = [F.sum(F.when(c, F.col("minutes"))).alias(f"{n}_minutes") for n, c in sums.items()]
    columns += [F.count(F.when(c, 1)).alias(f"{n}_ranges") for n, c in sums.items()]
    counted = gaps.groupBy("k", "start", "stop").agg(*columns, F.sum("minutes").alias("missing"))
    names = counted.columns[3:]
    every = requests.select("k", "start", "stop").distinct().join(counted, ["k", "start", "stop"], "left")
    return every.select("k", "start", "stop", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names])


def missing_keys(requests: DataFrame, rows: DataFrame, step: int = MINUTE) -> DataFrame:
    """(k, t) of every requested minute without a row, for each distinct request; only what is missing is listed."""
    return gap_ranges(requests, rows, step).select("k", F.explode(F.sequence("gap_start", "gap_end", F.lit(step))).alias("t"))


def coverage_by_series(requests: DataFrame, rows: DataFrame, quarantined: DataFrame, excluded: DataFrame, source: DataFrame, step: int = MINUTE) -> DataFrame:
    """Expected, observed, missing, duplicate, unexpected and explained minutes of each series, and whether it passed.

    quarantined and excluded are keys (k, t) that explain a missing minute; `source` are the keys that the
    canonical rows should equal. What no reason explains, the source returned no data for. unexpected counts an
    instrument's keys outside the request, source_mismatch its keys that only one of rows and source has; rows between
    two steps are unexpected and mismatched, each.

    All four tables become presence words in one shuffle, kept in the shared folder; counts are of bits of words and
    their AND NOT. Only where a request ends inside a word that has repeated rows are that word's rows looked at again.
    """
    checkpoints(rows.sparkSession)
    words = presence(step, row=rows, quarantined=quarantined, excluded=excluded, source=source).checkpoint()
    ones = lambda c: F.bit_count(c).cast("long")
    series = ["k", "start", "stop"]
    met = within_requests(requests, words, step)
    repeats = F.col("row_rows") - ones("row")
    lost = F.col("mask").bitwiseAND(F.bitwise_not("row"))
    sums = met.groupBy(*series).agg(
        F.sum(ones(F.col("row").bitwiseAND(F.col("mask")))).alias("observed"),
        F.sum(F.when(F.col("mask") == FULL, repeats).otherwise(0)).alias("duplicates"),
        *[F.sum(ones(F.col(c).bitwiseAND(lost))).alias(f"{c}_missing") for c in ("quarantined", "excluded")])
    totals = words.groupBy("k").agg(
        F.sum(ones("row") + F.col("row_off")).alias("keys"),
        F.sum(ones(F.col("row").bitwiseXOR(F.col("source"))) + F.col("row_off") + F.col("source_off")).alias("source_mismatch"))
    joined = requests.select(*series).join(sums, series, "left").join(totals, "k", "left")
    counts = ["observed", "duplicates", "quarantined_missing", "excluded_missing", "keys", "source_mismatch"]
    filled = joined.select(*series, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    cut = met.filter((F.col("mask") != FULL) & (repeats > 0)).select(*series, "word", "mask")
    if not cut.isEmpty():
        span = step * 60
        again = rows.select("k", "t", (F.col("t") - F.pmod("t", F.lit(span))).alias("word")).filter(F.pmod("t", F.lit(step)) == 0)
        again = again.join(cut.select("k", "word").distinct(), ["k", "word"], "left_semi").groupBy("k", "word", "t").agg((F.count("*") - 1).alias("n")).filter("n > 0")
        inside = again.join(cut, ["k", "word"]).filter("t between start and stop").groupBy(*series).agg(F.sum("n").alias("more"))
        filled = filled.join(inside, series, "left").withColumn("duplicates", F.col("duplicates") + F.coalesce("more", F.lit(0)))
    filled = filled.select(
        *series, ((F.col("stop") - F.col("start")) / step + 1).cast("long").alias("expected"), "observed", (F.col("observed") + F.col("duplicates")).alias("row_count"), "duplicates",
        (F.col("keys") - F.col("observed")).alias("unexpected"), "source_mismatch", "quarantined_missing", "excluded_missing")
    filled = filled.withColumn("missing", F.col("expected") - F.col("observed"))
    filled = filled.withColumn("no_data", F.col("missing") - F.col("quarantined_missing") - F.col("excluded_missing"))
    passed = (F.col("missing") == 0) & (F.col("row_count") == F.col("expected")) & (F.col("duplicates") + F.col("unexpected") + F.col("source_mismatch") == 0)
    return filled.withColumn("passed", passed)


def coverage_campaign(coverage: DataFrame, kind: str = "kind") -> DataFrame:
    """Sums of coverage by kind and overall (kind null), blocked if any series is."""
    counts = ["expected", "observed", "missing", "duplicates", "unexpected"]
    return coverage.rollup(kind).agg(F.count("*").alias("series"), *[F.sum(c).alias(c) for c in counts], F.bool_and("passed").alias("passed"))


def tiling_check(pages: DataFrame, requests: DataFrame, step: int = MINUTE) -> DataFrame:
    """Whether the pages (k, page_start, page_end, n) of each series touch without gap or overlap and cover it."""
    line = Window.partitionBy("k").orderBy("page_start", "page_end")
    marked = pages.withColumn("prev", F.lag("page_end").over(line))
    sums = marked.groupBy("k").agg(
        F.count("*").alias("pages"), F.min("page_start").alias("first"), F.max("page_end").alias("last"),
        F.count(F.when(F.col("page_start") > F.col("prev") + step, 1)).alias("holes"),
        F.count(F.when(F.col("page_start") < F.col("prev") + step, 1)).alias("overlaps"),
        F.count(F.when(F.col("n") == 0, 1)).alias("empty_pages"))
    joined = requests.select("k", "start", "stop").join(sums, "k", "left")
    tiled = (F.col("holes") == 0) & (F.col("overlaps") == 0) & (F.col("first") == F.col("start")) & (F.col("last") == F.col("stop"))
    return joined.select("k", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("pages", "holes", "overlaps", "empty_pages")], F.coalesce(tiled, F.lit(False)).alias("tiled"))


def merge_intervals(intervals: DataFrame, step: int = MINUTE) -> DataFrame:
    """(k, start, stop, parts, overlaps): inclusive intervals that touch or overlap become one; overlaps are counted."""
    line = Window.partitionBy("k").orderBy("start", "stop")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    marked = intervals.select("k", "start", "stop", F.max("stop").over(before).alias("reach"))
    fresh = F.coalesce(F.col("start") > F.col("reach") + step, F.lit(True)).cast("int")
    numbered = marked.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(line))
    overlap = F.col("start") <= F.col("reach")
    return numbered.groupBy("k", "island").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("parts"), F.count(F.when(overlap, 1)).alias("overlaps")).drop("island")


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, counting repeats, with the side that has them."""
    columns = left.columns
    return left.exceptAll(right.select(*columns)).withColumn("side", F.lit("left")).unionByName(
        right.select(*columns).exceptAll(left).withColumn("side", F.lit("right")))


def page_shape(pages: DataFrame, size: int, step: int = MINUTE) -> DataFrame:
    """Of each page (page, place, t): whether it has exactly `size` contiguous minutes in descending order."""
    line = Window.partitionBy("page").orderBy("place")
    falls = F.coalesce(F.col("t") == F.lag("t").over(line) - step, F.lit(True))
    marked = pages.withColumn("falls", falls)
    return marked.groupBy("page").agg(
        F.count("*").alias("n"), F.min("t").alias("first"), F.max("t").alias("last"),
        (F.bool_and("falls") & (F.count("*") == size) & (F.countDistinct("t") == size)).alias("full"))
