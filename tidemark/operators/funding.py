"""Settlement chronologies: intervals, audits, cadence repairs and hourly episodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.functions.times import MINUTE
from tidemark.operators.gaps import tiling_check

# Fixed values of the cadence policy.
POLICY_START_MS = 1_772_074_800_000
HOURLY = 60
DEFAULT_INTERVALS = (120, 240, 480)
LOW_RATE = "0.00025"
LEAST_TRAILING, MOST_TRAILING = 16, 17


def in_time() -> WindowSpec:
    return Window.partitionBy("k").orderBy("t")


def derive_intervals(rows: DataFrame, boundary: DataFrame | None = None) -> DataFrame:
    """rows (k, t, ...) with minutes since the previous settlement; the first uses boundary (k, before).

    `interval_ok` is false where the interval isn't a positive whole number of minutes; without a boundary
    the first interval is null and not ok.
    """
    previous = F.lag("t").over(in_time())
    if boundary is not None:
        rows = rows.join(boundary.select("k", "before"), "k", "left")
        previous = F.coalesce(previous, F.col("before"))
    made = rows.withColumn("previous", previous)
    step = F.col("t") - F.col("previous")
    ok = (step > 0) & (F.pmod(step, F.lit(MINUTE)) == 0)
    made = made.withColumn("interval", F.when(ok, (step / MINUTE).cast("long"))).withColumn("interval_ok", F.coalesce(ok, F.lit(False)))
    return made.drop("before") if boundary is not None else made


def interval_histogram(rows: DataFrame) -> DataFrame:
    """(k, interval, n, stable): how often each interval occurs, and whether it is the instrument's only one."""
    counts = rows.filter(F.col("interval").isNotNull()).groupBy("k", "interval").agg(F.count("*").alias("n"))
    return counts.withColumn("stable", F.count("*").over(Window.partitionBy("k")) == 1)


def chronology_audit(rows: DataFrame, requests: DataFrame) -> DataFrame:
    """Counts of defects of each series' rows (k, t, interval): duplicates, out of range, interval mismatches, changes.

    requests are (k, start, stop, before): `before` is the settlement that precedes the range.
    """
    met = requests.join(rows, "k", "left")
    line = Window.partitionBy("k").orderBy("t", "interval")
    previous = F.lag("t").over(line)
    step = (F.col("t") - F.coalesce(previous, F.col("before"))) / MINUTE
    marked = met.withColumns({"first": F.row_number().over(line) == 1, "same": F.col("t") == previous, "step": step, "previous_interval": F.lag("interval").over(line)})
    wrong = F.col("step") != F.col("interval")
    audit = marked.groupBy("k").agg(
        F.count("t").alias("rows"),
        F.count(F.when(F.col("same"), 1)).alias("duplicates"),
        F.count(F.when((F.col("t") < F.col("start")) | (F.col("t") > F.col("stop")), 1)).alias("out_of_range"),
        F.count(F.when(F.col("first") & wrong, 1)).alias("predecessor_mismatch"),
        F.count(F.when(~F.col("first") & wrong, 1)).alias("internal_mismatch"),
        F.count(F.when(F.col("interval") != F.col("previous_interval"), 1)).alias("interval_changes"))
    clean = F.col("duplicates") + F.col("out_of_range") + F.col("predecessor_mismatch") + F.col("internal_mismatch") == 0
    return audit.withColumn("passed", clean & (F.col("rows") > 0))


def union_audit(rows: DataFrame) -> DataFrame:
    """(k, rows, fragments, duplicates, interval_mismatch) of the union (k, t, interval, fragment) of settlement fragments.

    Rows are compared with the one before them in their series, whichever fragment it is from; a null interval on
    any but the first row of a series is a mismatch.
    """
    previous = F.lag("t").over(Window.partitionBy("k").orderBy("t", "interval"))
    line = rows.select("k", "t", "interval", "fragment", previous.alias("previous"))
    wrong = F.col("previous").isNotNull() & ~F.col("interval").eqNullSafe((F.col("t") - F.col("previous")) / MINUTE)
    return line.groupBy("k").agg(
        F.count("*").alias("rows"), F.countDistinct("fragment").alias("fragments"),
        F.count(F.when(F.col("t") == F.col("previous"), 1)).alias("duplicates"), F.count(F.when(wrong, 1)).alias("interval_mismatch"))


def chronology_anomalies(rows: DataFrame) -> DataFrame:
    """(k, t, kind) of each duplicate key and each change of interval in rows (k, t, interval)."""
    line = Window.partitionBy("k").orderBy("t", "interval")
    marked = rows.withColumns({"same": F.col("t") == F.lag("t").over(line), "before": F.lag("interval").over(line)})
    kinds = F.array_compact(F.array(F.when(F.col("same"), F.lit("duplicate_key")), F.when(F.col("interval") != F.col("before"), F.lit("interval_change"))))
    return marked.select("k", "t", F.explode(kinds).alias("kind"))


def cadence_sandwiches(rows: DataFrame) -> DataFrame:
    """Settlements that patterns C, nC, C (n > 1) miss: (k, t, interval C, gap nC, after, before).

    A series counts only if every change of interval is an edge of such a pattern.
    """
    marked = rows.select("k", "t", "interval").withColumns({
        "low": F.lag("interval").over(in_time()), "high": F.lead("interval").over(in_time()), "before": F.lag("t").over(in_time())})
    hit = (F.col("low") == F.col("high")) & (F.col("interval") > F.col("low")) & (F.pmod("interval", F.col("low")) == 0)
    marked = marked.withColumn("hit", F.coalesce(hit, F.lit(False)))
    edge = F.coalesce(F.col("interval") != F.col("low"), F.lit(False))
    explained = F.col("hit") | F.coalesce(F.lag("hit").over(in_time()), F.lit(False))
    marked = marked.withColumn("unexplained", edge & ~explained)
    whole = Window.partitionBy("k")
    good = marked.withColumn("bad", F.max("unexplained").over(whole)).filter(F.col("hit") & ~F.col("bad"))
    step = F.col("low") * MINUTE
    times = F.sequence(F.col("before") + step, F.col("before") + step * (F.floor(F.col("interval") / F.col("low")) - 1), step)
    return good.select("k", F.explode(times).alias("t"), F.col("low").alias("interval"), F.col("interval").alias("gap"), F.col("before").alias("after"), F.col("t").alias("until"))


def restate_intervals(parent: DataFrame, repaired: DataFrame) -> DataFrame:
    """parent (k, t, interval) and repaired (k, t) as one chronology: `restated` where a parent row's interval changed.

    An interval is the step from the row before, in whole minutes; a step of part minutes has none (null, interval_ok false).
    """
    both = parent.select("k", "t", F.col("interval").alias("old"), F.lit("parent").alias("origin")).unionByName(
        repaired.select("k", "t", F.lit(None).cast("long").alias("old"), F.lit("repair").alias("origin")))
    made = both.withColumn("step", F.col("t") - F.lag("t").over(in_time()))
    made = made.withColumn("interval_ok", F.coalesce(F.pmod("step", F.lit(MINUTE)) == 0, F.lit(True)))
    made = made.withColumn("interval", F.when(F.col("step").isNull(), F.col("old")).when(F.col("interval_ok"), F.expr(f"step div {MINUTE}"))).drop("step")
    return made.withColumn("restated", (F.col("origin") == "parent") & ~F.col("interval").eqNullSafe(F.col("old")))


def source_boundary(rows: DataFrame) -> DataFrame:
    """(k, predecessor, first_start): each series' oldest settlement and the second oldest, null where it has one."""
    ranked = rows.select("k", "t").distinct().withColumn("place", F.row_number().over(in_time())).filter("place <= 2")
    return ranked.groupBy("k").agg(F.max(F.when(F.col("place") == 1, F.col("t"))).alias("predecessor"), F.max(F.when(F.col("place") == 2, F.col("t"))).alias("first_start"))


def confirm_candidates(planned: DataFrame, returned: DataFrame) -> DataFrame:
    """(k, planned, returned, missing, unexpected, passed) of settlements (k, t) planned and returned."""
    joined = planned.select("k", "t").distinct().withColumn("p", F.lit(1)).join(returned.select("k", "t").distinct().withColumn("r", F.lit(1)), ["k", "t"], "full_outer")
    counted = joined.groupBy("k").agg(
        F.count("p").alias("planned"), F.count("r").alias("returned"),
        F.count(F.when(F.col("r").isNull(), 1)).alias("missing"), F.count(F.when(F.col("p").isNull(), 1)).alias("unexpected"))
    return counted.withColumn("passed", (F.col("missing") == 0) & (F.col("unexpected") == 0))


def cadence_episodes(rows: DataFrame, start_ms: int = POLICY_START_MS, low_rate: str = LOW_RATE) -> DataFrame:
    """Whether hourly episodes explain every change of interval in each series of rows (k, t, rate, interval).

    Runs are maximal stretches of hourly or of other intervals, so the runs before and after an hourly run
    are what lies between it and its hourly neighbours. An entry needs one constant default before it. An
    ended run needs two rows after it at least: an alignment interval, then one default; and 16 or 17 rows of
    low rate at its end. A run still open may have at most 17. Without hourly runs the interval is one default
    throughout. A series that breaks a rule explains nothing.
    """
    line = in_time()
    df = rows.select("k", "t", F.abs("rate").alias("rate"), "interval").withColumns({
        "prev": F.lag("interval").over(line), "hourly": F.col("interval") == HOURLY, "place": F.row_number().over(line)})
    df = df.withColumn("new_run", F.coalesce(F.col("hourly") != F.lag("hourly").over(line), F.lit(True)).cast("int"))
    df = df.withColumn("run", F.sum("new_run").over(line))
    inside = Window.partitionBy("k", "run").orderBy("place")
    df = df.withColumn("at", F.row_number().over(inside))
    high = F.col("rate") > F.lit(low_rate).cast("decimal(10,8)")
    runs = df.groupBy("k", "run").agg(
        F.first("hourly").alias("hourly"), F.count("*").alias("n"), F.min("t").alias("first_t"),
        F.max(F.when(F.col("at") == 1, F.col("interval"))).alias("one"), F.max(F.when(F.col("at") == 2, F.col("interval"))).alias("two"),
        F.min("interval").alias("low"), F.max("interval").alias("top"),
        F.min(F.when(F.col("at") >= 2, F.col("interval"))).alias("rest_low"), F.max(F.when(F.col("at") >= 2, F.col("interval"))).alias("rest_top"),
        F.max(F.when(high, F.col("at"))).alias("last_high"),
        F.count(F.when(F.col("prev").isNotNull() & (F.col("interval") != F.col("prev")), 1)).alias("changes"))
    order = Window.partitionBy("k").orderBy("run")
    neighbours = {f"before_{c}": F.lag(c).over(order) for c in ("low", "top")} | {f"after_{c}": F.lead(c).over(order) for c in ("n", "one", "two", "rest_low", "rest_top")}
    runs = runs.withColumns(neighbours).withColumn("trailing", F.col("n") - F.coalesce("last_high", F.lit(0)))
    has_before, has_after = F.col("run") > 1, F.col("after_n").isNotNull()
    entry_ok = ~has_before | ((F.col("before_low") == F.col("before_top")) & F.col("before_low").isin(*DEFAULT_INTERVALS))
    aligned = (F.col("after_one") > HOURLY) & (F.col("after_one") <= F.col("after_two")) & (F.pmod("after_one", F.lit(HOURLY)) == 0)
    restored = (F.col("after_n") >= 2) & F.col("after_two").isin(*DEFAULT_INTERVALS) & (F.col("after_rest_low") == F.col("after_rest_top")) & aligned
    exit_ok = F.when(has_after, F.coalesce(restored, F.lit(False)) & F.col("trailing").between(LEAST_TRAILING, MOST_TRAILING)).otherwise(F.col("trailing") <= MOST_TRAILING)
    explained = has_before.cast("int") + F.when(has_after, 1 + (F.col("after_one") != F.col("after_two")).cast("int")).otherwise(0)
    stable = (F.col("low") == F.col("top")) & F.col("low").isin(*DEFAULT_INTERVALS)
    hourly = F.col("hourly")
    per = runs.groupBy("k").agg(
        F.min("first_t").alias("first_t"), F.sum("changes").alias("changes"), F.count(F.when(hourly, 1)).alias("episodes"),
        F.coalesce(F.sum(F.when(hourly, explained)), F.lit(0)).alias("explained"), F.bool_and(F.when(hourly, entry_ok & exit_ok).otherwise(True)).alias("rules"),
        F.bool_and(stable).alias("stable"), F.count(F.when(hourly & has_after, 1)).alias("completed"), F.count(F.when(hourly & ~has_after, 1)).alias("open"),
        F.count(F.when(hourly & ~has_after & (F.col("trailing") < LEAST_TRAILING), 1)).alias("open_nonqualifying"))
    fits = (F.col("first_t") >= start_ms) & F.when(F.col("episodes") == 0, (F.col("changes") == 0) & F.col("stable")).otherwise(F.col("rules") & (F.col("explained") == F.col("changes")))
    zero = F.lit(0).cast("long")
    parts = {c: F.when(fits, F.col(c)).otherwise(zero) for c in ("episodes", "completed", "open", "open_nonqualifying", "explained")}
    return per.select("k", *[v.cast("long").alias(c) for c, v in parts.items()], F.when(fits, zero).otherwise(F.col("changes")).alias("unexplained"))


def pair_candidates(rows: DataFrame) -> DataFrame:
    """(part, a, b, class) of every two datasets, a before b, of a partition of settlements (part, dataset, shape, k, t, interval).

    `schema`: their shapes differ. Else by the first row of their union in order of (k, t) that can't follow the one before
    it: `duplicate` where both have the key, `interval` where the step from the settlement before isn't the stated interval
    (or none is stated). `eligible` where there is no such row. A dataset has one shape.
    """
    sets = rows.groupBy("part", "dataset").agg(F.min("shape").alias("shape"))
    one, two = (sets.select("part", F.col("dataset").alias(n), F.col("shape").alias(f"shape_{n}")) for n in "ab")
    pairs = one.join(two, "part").filter("a < b")  # datasets of one partition, not rows
    alike = pairs.filter(F.col("shape_a").eqNullSafe(F.col("shape_b"))).select("part", "a", "b", F.explode(F.array("a", "b")).alias("dataset"))
    line = Window.partitionBy("part", "a", "b", "k").orderBy("t", "interval")
    union = rows.select("part", "dataset", "k", "t", "interval").join(alike, ["part", "dataset"]).withColumn("previous", F.lag("t").over(line))
    stated = F.coalesce(F.col("t") - F.col("previous") == F.col("interval") * MINUTE, F.lit(False))
    problem = F.when(F.col("t") == F.col("previous"), "duplicate").when(F.col("previous").isNotNull() & ~stated, "interval")
    first = union.withColumn("problem", problem).filter("problem is not null").groupBy("part", "a", "b").agg(F.min_by("problem", F.struct("k", "t", "problem")).alias("problem"))
    met = pairs.join(first, ["part", "a", "b"], "left")
    kind = F.when(~F.col("shape_a").eqNullSafe(F.col("shape_b")), "schema").otherwise(F.coalesce("problem", F.lit("eligible")))
    return met.select("part", "a", "b", kind.alias("class"))


def coverage_audit(rows: DataFrame, requests: DataFrame, pages: DataFrame, life: DataFrame) -> DataFrame:
    """chronology_audit() of each requested series with its source pages, its lifecycle and the verdict of them together.

    pages: (k, page_start, page_end, n) of the range pages; they must tile the request, and an empty one fails the series, as
    a source that returns nothing isn't proof of nothing. life: (k, launch, delivery), delivery null while it trades;
    a series without one is outside. unexpected counts the distinct times out of the request, stable_interval is the
    interval if there is one only. passed: no defect, no change of interval, whole tiling, in its lifecycle.
    """
    audit = chronology_audit(rows, requests).drop("passed")
    tiled = tiling_check(pages, requests)
    spans = pages.groupBy("k").agg(F.sum(F.expr(f"(page_end - page_start) div {MINUTE} + 1")).alias("window_minutes"))
    own = requests.join(rows, "k").groupBy("k").agg(
        F.count_distinct(F.when(~F.col("t").between(F.col("start"), F.col("stop")), F.col("t"))).alias("unexpected"),
        F.when(F.min("interval") == F.max("interval"), F.min("interval")).alias("stable_interval"))
    within = F.coalesce((F.col("start") >= F.col("launch")) & (F.col("delivery").isNull() | (F.col("stop") <= F.col("delivery"))), F.lit(False))
    placed = requests.join(life, "k", "left").select("k", "start", "stop", within.alias("within_life"))
    met = placed.join(audit, "k").join(tiled, "k").join(spans, "k", "left").join(own, "k", "left")
    met = met.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("window_minutes", "unexpected")})
    defects = reduce(Column.__add__, [F.col(c) for c in ("duplicates", "unexpected", "predecessor_mismatch", "internal_mismatch", "interval_changes", "empty_pages")])
    passed = (defects == 0) & (F.col("rows") > 0) & F.col("tiled") & F.col("within_life")
    return met.select("k", "rows", "duplicates", "unexpected", "predecessor_mismatch", "internal_mismatch", "interval_changes", "stable_interval",
                      "pages", "empty_pages", "window_minutes", "tiled", "within_life", passed.alias("passed"))


def coverage_reasons(audit: DataFrame, rows: DataFrame, requests: DataFrame) -> DataFrame:
    """(reason, n) over coverage_audit(): how often each reason to refuse a campaign occurs, zeros included.

    Rows of series that nobody requested are a reason of their own.
    """
    sums = audit.agg(*[F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(c) for c in ("duplicates", "unexpected", "predecessor_mismatch", "internal_mismatch", "interval_changes", "empty_pages")],
                     F.count(F.when(~F.col("within_life"), 1)).alias("outside"), F.count(F.when(~F.col("tiled"), 1)).alias("untiled"))
    strange = rows.join(requests.select("k").distinct(), "k", "left_anti").agg(F.count("*").alias("strange"))
    names = {"duplicate_canonical_key": "duplicates", "unexpected_settlement_timestamp": "unexpected", "predecessor_interval_mismatch": "predecessor_mismatch",
             "internal_interval_mismatch": "internal_mismatch", "unexplained_interval_change": "interval_changes", "source_window_returned_no_event": "empty_pages",
             "registry_lifecycle_failure": "outside", "range_not_tiled": "untiled", "unrequested_instrument_row": "strange"}
    each = F.explode(F.array(*[F.struct(F.lit(reason).alias("reason"), F.col(c).alias("n")) for reason, c in names.items()]))
    return sums.crossJoin(strange).select(each.alias("x")).select("x.*")  # one row each


def coverage_anomalies(rows: DataFrame, requests: DataFrame, pages: DataFrame) -> DataFrame:
    """(k, reason, place, start, stop): every defect of the requested series as a row.

    place numbers a series' rows from 0 by (time, interval); start and stop are those of an empty page. A series without
    rows has a predecessor mismatch without a place.
    """
    line = Window.partitionBy("k").orderBy("t", "interval")
    met = requests.select("k", "before").join(rows.select("k", "t", "interval"), "k", "left")
    marked = met.withColumns({"place": F.row_number().over(line) - 1, "previous": F.coalesce(F.lag("t").over(line), F.col("before")), "previous_interval": F.lag("interval").over(line)})
    wrong = ~F.coalesce(F.col("t") - F.col("previous") == F.col("interval") * MINUTE, F.lit(False))
    reasons = F.array_compact(F.array(
        F.when(wrong, F.when(F.col("place") == 0, "predecessor_interval_mismatch").otherwise("internal_interval_mismatch")),
        F.when(F.col("interval") != F.col("previous_interval"), F.lit("unexplained_interval_change"))))
    none = F.lit(None).cast("long")
    found = marked.select("k", F.explode(reasons).alias("reason"), F.when(F.col("t").isNotNull(), F.col("place").cast("long")).alias("place"), none.alias("start"), none.alias("stop"))
    empty = pages.filter("n = 0").join(requests.select("k"), "k", "left_semi")
    return found.unionByName(empty.select("k", F.lit("source_window_returned_no_event").alias("reason"), none.alias("place"), F.col("page_start").alias("start"), F.col("page_end").alias("stop")))
