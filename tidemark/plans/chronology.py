"""Queries of settlement chronologies on orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.times import DAY
from tidemark.operators import funding as ops, maintenance
from tidemark.plans.catalog import scratch
from tidemark.plans.registry import query
from tidemark.plans.sql import with_views
from tidemark.sources import views

TIMED = "timed as (select k, t, rate, lag(t) over (partition by k order by t) as previous from settlements), iv as (select *, (t - previous) // 60000 as step from timed)"


def _rows(spark, sf_dir):
    return ops.derive_intervals(views.settlements(spark, sf_dir))


@query("E15_derive_funding_interval", with_views("settlements", sql="""with b as (select k, min(t) - 86400000 as before from settlements group by k)
  select s.k, s.t, ((s.t - coalesce(lag(s.t) over (partition by s.k order by s.t), b.before)) // 60000)::bigint as step, true as interval_ok from settlements s join b on s.k = b.k"""))
def derive(spark, sf_dir):
    rows = views.settlements(spark, sf_dir)
    boundary = rows.groupBy("k").agg((F.min("t") - DAY).alias("before"))
    return ops.derive_intervals(rows, boundary).select("k", "t", F.col("interval").alias("step"), "interval_ok")




@query("D7_interval_histogram", with_views("settlements", sql=f"""with {TIMED}, counts as (select k, step // 144000 as span, count(*) as n from iv where step is not null group by all)
  select k, span, n, count(*) over (partition by k) = 1 as stable from counts"""))
def histogram(spark, sf_dir):
    rows = _rows(spark, sf_dir).withColumn("interval", F.floor(F.col("interval") / 144_000))
    return ops.interval_histogram(rows).withColumnRenamed("interval", "span")


AUDITED = """audited as (select k, t, (case when id % 5 = 0 then (t - lag(t) over (partition by k order by t, id)) // 60000 + 60 else (t - lag(t) over (partition by k order by t, id)) // 60000 end)::bigint as raw, id from settlement_rows),
given as (select k, t, coalesce(raw, 480) as interval from audited),
requests as (select k, min(t) as start, max(t) - 86400000 as stop, min(t) - 480 * 60000 as before from settlement_rows group by k)"""


def _audited(spark, sf_dir):
    from pyspark.sql import Window

    rows = views.settlement_rows(spark, sf_dir)
    step = F.floor((F.col("t") - F.lag("t").over(Window.partitionBy("k").orderBy("t", "id"))) / 60_000)
    step = F.when(F.pmod("id", F.lit(5)) == 0, step + 60).otherwise(step)
    given = rows.select("k", "t", F.coalesce(step, F.lit(480)).alias("interval"))
    requests = rows.groupBy("k").agg(F.min("t").alias("start"), (F.max("t") - DAY).alias("stop"), (F.min("t") - 480 * 60_000).alias("before"))
    return given, requests


AUDIT = f"""{AUDITED},
marked as (select g.k, g.t, g.interval, r.start, r.stop, row_number() over w = 1 as first, g.t = lag(g.t) over w as same, (g.t - coalesce(lag(g.t) over w, r.before)) // 60000 as step,
  lag(g.interval) over w as previous_interval from given g join requests r on g.k = r.k window w as (partition by g.k order by g.t, g.interval)),
audit as (select k, count(*) as "rows", count(*) filter (same) as duplicates, count(*) filter (t < start or t > stop) as out_of_range,
  count(*) filter (first and step <> interval) as predecessor_mismatch, count(*) filter (not first and step <> interval) as internal_mismatch,
  count(*) filter (interval <> previous_interval) as interval_changes from marked group by k)"""


@query("E16_funding_chronology_audit", with_views("settlement_rows", sql=f"with {AUDIT} select *, duplicates + out_of_range + predecessor_mismatch + internal_mismatch = 0 as passed from audit"))
def audit(spark, sf_dir):
    return ops.chronology_audit(*_audited(spark, sf_dir))


@query("E16_anomalies", with_views("settlement_rows", sql=f"with {AUDIT} select k, t, 'duplicate_key' as kind from marked where same union all select k, t, 'interval_change' from marked where interval <> previous_interval"))
def anomalies(spark, sf_dir):
    return ops.chronology_anomalies(_audited(spark, sf_dir)[0])


# pages of 90 days; series 3, 13, ... lack their second page, 9, 18, ... were launched late, every fourth ended before the request does,
# rows of 7, 14, ... were not requested, those of 5, 10, ... are regular but for their pages
PAGE_MS = 90 * DAY
COVERED = f"""{AUDIT},
asked as (select r.k, r.start, r.stop, r.before from requests r where r.k % 7 > 0),
regular as (select k, unnest(generate_series(start, start + 13795200000, 28800000)) as t, 480::bigint as interval from requests where k % 5 = 0),
facts as (select k, t, interval from given where k % 5 > 0 union all select * from regular),
wanted as (select k, start, case when k % 5 = 0 then start + 13795200000 else stop end as stop, before from asked),
pieces as (select k, start + i * {PAGE_MS} as page_start, least(start + (i + 1) * {PAGE_MS} - 60000, stop) as page_end
  from (select *, unnest(generate_series(0, (stop - start) // {PAGE_MS})) as i from wanted where stop >= start) where not (k % 10 = 3 and i = 1)),
pages as (select p.k, page_start, page_end, count(f.t) as n from pieces p left join facts f on f.k = p.k and f.t between page_start and page_end group by all),
tiles as (select k, count(*) as pages, count(*) filter (n = 0) as empty_pages, sum((page_end - page_start) // 60000 + 1)::bigint as window_minutes from pages group by k),
lined as (select f.k, f.t, f.interval, w.start, w.stop, row_number() over o - 1 as place, lag(f.t) over o as previous, lag(f.interval) over o as previous_interval, w.before
  from facts f join wanted w on f.k = w.k window o as (partition by f.k order by f.t, f.interval)),
counts as (select k, count(*) as "rows", count(*) filter (t = previous) as duplicates, count(distinct t) filter (t < start or t > stop) as unexpected,
  count(*) filter (place = 0 and t - before <> interval * 60000) as predecessor_mismatch, count(*) filter (place > 0 and t - previous <> interval * 60000) as internal_mismatch,
  count(*) filter (interval <> previous_interval) as interval_changes, case when min(interval) = max(interval) then min(interval) end as stable_interval from lined group by k),
judged as (select c.*, coalesce(pages, 0) as pages, coalesce(empty_pages, 0) as empty_pages, coalesce(window_minutes, 0) as window_minutes,
    pages is not null and not (c.k % 10 = 3 and w.stop - w.start >= {PAGE_MS}) as tiled, not (c.k % 9 = 0 or c.k % 4 = 1) as within_life from counts c join wanted w on w.k = c.k left join tiles on tiles.k = c.k),
verdicts as (select *, duplicates + unexpected + predecessor_mismatch + internal_mismatch + interval_changes + empty_pages = 0 and tiled and within_life as passed from judged)"""


def _covered(spark, sf_dir):
    """(rows, requests, pages, life) of the coverage audit."""
    given, asked = _audited(spark, sf_dir)
    end = F.col("start") + 479 * 28_800_000
    own = F.pmod("k", F.lit(5)) == 0
    regular = asked.filter(own).select("k", F.explode(F.sequence("start", end, F.lit(28_800_000))).alias("t"), F.lit(480).cast("long").alias("interval"))
    rows = given.filter(~own).select("k", "t", F.col("interval").cast("long").alias("interval")).unionByName(regular)
    wanted = asked.filter(F.pmod("k", F.lit(7)) > 0).withColumn("stop", F.when(own, end).otherwise(F.col("stop")))
    pieces = wanted.filter("stop >= start").select("k", "start", "stop", F.explode(F.sequence(F.lit(0), F.expr(f"(stop - start) div {PAGE_MS}"))).alias("i"))
    pieces = pieces.filter(~((F.pmod("k", F.lit(10)) == 3) & (F.col("i") == 1)))
    inside = rows.join(wanted.select("k", "start", "stop"), "k").filter("t between start and stop").groupBy("k", F.expr(f"(t - start) div {PAGE_MS}").alias("i")).agg(F.count("*").alias("n"))
    pages = pieces.join(inside, ["k", "i"], "left").select(
        "k", (F.col("start") + F.col("i") * PAGE_MS).alias("page_start"), F.least(F.col("start") + (F.col("i") + 1) * PAGE_MS - 60_000, F.col("stop")).alias("page_end"), F.coalesce("n", F.lit(0)).alias("n"))
    quarter = F.pmod("k", F.lit(4))
    life = wanted.select("k", F.when(F.pmod("k", F.lit(9)) == 0, F.col("start") + 1).otherwise(F.col("start")).alias("launch"), F.when(quarter == 1, F.col("stop") - 1).when(quarter == 2, F.col("stop")).alias("delivery"))
    return rows, wanted, pages, life


@query("E16_coverage_audit", with_views("settlement_rows", sql=f"with {COVERED} select * from verdicts"))
def coverage_audit(spark, sf_dir):
    return ops.coverage_audit(*_covered(spark, sf_dir))


@query("E16_coverage_reasons", with_views("settlement_rows", sql=f"""with {COVERED}, reasons as (
  select 'duplicate_canonical_key' as reason, sum(duplicates)::bigint as n from verdicts union all select 'unexpected_settlement_timestamp', sum(unexpected)::bigint from verdicts
  union all select 'predecessor_interval_mismatch', sum(predecessor_mismatch)::bigint from verdicts union all select 'internal_interval_mismatch', sum(internal_mismatch)::bigint from verdicts
  union all select 'unexplained_interval_change', sum(interval_changes)::bigint from verdicts union all select 'source_window_returned_no_event', sum(empty_pages)::bigint from verdicts
  union all select 'registry_lifecycle_failure', count(*) filter (not within_life) from verdicts union all select 'range_not_tiled', count(*) filter (not tiled) from verdicts
  union all select 'unrequested_instrument_row', count(*) from facts where k % 7 = 0)
  select * from reasons"""))
def coverage_reasons(spark, sf_dir):
    rows, wanted, pages, life = _covered(spark, sf_dir)
    return ops.coverage_reasons(ops.coverage_audit(rows, wanted, pages, life), rows, wanted)


@query("E16_coverage_anomalies", with_views("settlement_rows", sql=f"""with {COVERED}
  select k, case when place = 0 then 'predecessor_interval_mismatch' else 'internal_interval_mismatch' end as reason, place, null::bigint as start, null::bigint as stop from lined
    where t - (case when place = 0 then before else previous end) <> interval * 60000
  union all select k, 'unexplained_interval_change', place, null, null from lined where interval <> previous_interval
  union all select k, 'source_window_returned_no_event', null, page_start, page_end from pages where n = 0"""))
def coverage_anomalies(spark, sf_dir):
    rows, wanted, pages, _ = _covered(spark, sf_dir)
    return ops.coverage_anomalies(rows, wanted, pages)


# a regular chronology of 480 minutes for each instrument, from which every 97th key by id and place is missing
REGULAR = """placed as (select k, id, row_number() over (partition by k order by t) as place from settlements),
kept as (select k, place * 28800000 as t from placed where (k * 7 + place) % 6 <> 0),
iv as (select k, t, (t - lag(t) over (partition by k order by t)) // 60000 as interval from kept),
known as (select * from iv where interval is not null)"""


def _regular(spark, sf_dir):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("k").orderBy("t")).cast("long")
    placed = views.settlements(spark, sf_dir).select("k", place.alias("place"))
    kept = placed.filter(F.pmod(F.col("k") * 7 + F.col("place"), F.lit(6)) != 0).select("k", (F.col("place") * 28_800_000).alias("t"))
    return ops.derive_intervals(kept).filter("interval is not null").select("k", "t", "interval")


SANDWICH = f"""{REGULAR},
near as (select *, lag(interval) over w as low, lead(interval) over w as high, lag(t) over w as before from known window w as (partition by k order by t)),
hits as (select *, coalesce(low = high and interval > low and interval % low = 0, false) as hit, coalesce(interval <> low, false) as edge from near),
judged as (select *, edge and not (hit or coalesce(lag(hit) over (partition by k order by t), false)) as unexplained from hits),
good as (select * from judged where hit and k not in (select k from judged where unexplained)),
missed as (select k, unnest(generate_series(before + low * 60000, t - low * 60000, low * 60000)) as t, low as interval, interval as gap, before as after, t as until from good)"""


@query("E17_cadence_sandwiches", with_views("settlements", sql=f"with {SANDWICH} select * from missed"))
def sandwiches(spark, sf_dir):
    return ops.cadence_sandwiches(_regular(spark, sf_dir))


@query("H9_plan_funding_repairs", with_views("settlements", sql=f"""with {SANDWICH}
  select k, count(*) as settlements, min(t) as start, max(t) as stop, min(interval)::bigint as interval from missed group by k"""))
def plan_repairs(spark, sf_dir):
    return ops.cadence_sandwiches(_regular(spark, sf_dir)).groupBy("k").agg(
        F.count("*").alias("settlements"), F.min("t").alias("start"), F.max("t").alias("stop"), F.min("interval").alias("interval"))


RESTATED = f"""{SANDWICH},
both_rows as (select k, t, interval as old, 'parent' as origin from known union all select k, t, null, 'repair' from missed),
restated as (select k, t, old, origin, coalesce((t - lag(t) over (partition by k order by t)) // 60000, old)::bigint as interval from both_rows)"""


def _restated(spark, sf_dir):
    parent = _regular(spark, sf_dir)
    return ops.restate_intervals(parent, ops.cadence_sandwiches(parent))


# some parent rows lie half a minute late, so the steps to and from them aren't whole minutes
@query("E19_restate_intervals", with_views("settlements", sql=f"""with {SANDWICH},
  both_rows as (select k, t + case when t // 60000 % 7 = 0 then 30000 else 0 end as t, interval as old, 'parent' as origin from known union all select k, t, null, 'repair' from missed),
  stepped as (select *, t - lag(t) over (partition by k order by t) as step from both_rows),
  restated as (select *, coalesce(step % 60000 = 0, true) as interval_ok, case when step is null then old when step % 60000 = 0 then step // 60000 end as interval from stepped)
  select k, t, interval, interval_ok, origin, origin = 'parent' and interval is distinct from old as restated from restated"""))
def restate(spark, sf_dir):
    parent = _regular(spark, sf_dir)
    late = F.when(F.pmod(F.floor(F.col("t") / 60_000), F.lit(7)) == 0, 30_000).otherwise(0)
    rows = ops.restate_intervals(parent.withColumn("t", F.col("t") + late), ops.cadence_sandwiches(parent))
    return rows.select("k", "t", "interval", "interval_ok", "origin", "restated")


@query("H10_apply_funding_repair", with_views("settlements", sql=f"""with {RESTATED}
  select k, count(*) as child, count(*) filter (origin = 'parent') as parent, count(*) filter (origin = 'repair') as repaired,
    count(*) filter (origin = 'parent' and interval is distinct from old) as restated, count(distinct t) = count(*) as unique_keys from restated group by k"""))
def apply_repair(spark, sf_dir):
    return _restated(spark, sf_dir).groupBy("k").agg(
        F.count("*").alias("child"), F.count(F.when(F.col("origin") == "parent", 1)).alias("parent"), F.count(F.when(F.col("origin") == "repair", 1)).alias("repaired"),
        F.count(F.when(F.col("restated"), 1)).alias("restated"), (F.countDistinct("t") == F.count("*")).alias("unique_keys"))


@query("H11_repair_reaudit", with_views("settlements", sql=f"""with {RESTATED}, line as (select *, lag(interval) over (partition by k order by t) as prev, (t - lag(t) over (partition by k order by t)) // 60000 as step from restated)
  select k, count(*) as "rows", count(*) filter (step <> interval) as internal_mismatch, count(*) filter (interval <> prev) as interval_changes from line group by k"""))
def reaudit(spark, sf_dir):
    rows = _restated(spark, sf_dir).select("k", "t", "interval")
    requests = rows.groupBy("k").agg(F.min("t").alias("start"), F.max("t").alias("stop"), F.min("t").alias("before"))
    return ops.chronology_audit(rows, requests).select("k", "rows", "internal_mismatch", "interval_changes")


@query("C9_confirm_candidates", with_views("settlements", sql=f"""with {SANDWICH}, came as (select k, t from missed where (t // 28800000 + k) % 4 <> 0 union all select k, max(t) + 1 from missed group by k),
  j as (select coalesce(p.k, r.k) as k, p.t as pt, r.t as rt from missed p full join came r on p.k = r.k and p.t = r.t)
  select k, count(pt) as planned, count(rt) as returned, count(*) filter (rt is null) as missing, count(*) filter (pt is null) as unexpected,
    count(*) filter (rt is null) = 0 and count(*) filter (pt is null) = 0 as passed from j group by k"""))
def confirm(spark, sf_dir):
    planned = ops.cadence_sandwiches(_regular(spark, sf_dir)).select("k", "t")
    came = planned.filter(F.pmod(F.floor(F.col("t") / 28_800_000) + F.col("k"), F.lit(4)) != 0)
    return ops.confirm_candidates(planned, came.unionByName(planned.groupBy("k").agg((F.max("t") + 1).alias("t"))))


@query("D15_source_boundary", with_views("settlements", sql="""with r as (select k, t, row_number() over (partition by k order by t) as place from settlements)
  select k, max(t) filter (place = 1) as predecessor, max(t) filter (place = 2) as first_start from r where place <= 2 group by k"""))
def boundary(spark, sf_dir):
    return ops.source_boundary(views.settlements(spark, sf_dir))


def _episode_rows(spark, sf_dir):
    """(k, t, rate, interval): settlements of four instruments each as one series, with an hourly run of 16 to 20 rows from its
    5th, 13th, 21st, 29th or 37th row on, of which the last 14 to 18 have low rates; series may end before or in it."""
    from pyspark.sql import Window

    line, placed = Window.partitionBy("k").orderBy("place"), Window.partitionBy("k").orderBy("t", "instrument")
    rows = views.settlements(spark, sf_dir).withColumn("instrument", F.col("k")).withColumn("k", F.floor(F.col("k") / 4))
    rows = rows.withColumn("place", F.row_number().over(placed)).withColumn("at", F.col("place") - 4 - 8 * F.pmod("k", F.lit(5)))
    length = 16 + F.pmod(F.floor(F.col("k") / 5), F.lit(5))
    quiet = length - 14 - F.pmod(F.floor(F.col("k") / 2), F.lit(5))  # rows of the run before the low ones, the last of them high
    interval = F.when(F.col("at").between(1, length), 60).otherwise(480).cast("long")
    low = F.when(F.col("at").between(1, length), F.col("at") > quiet).otherwise(False) | ((F.col("at") != quiet) & (F.pmod("rate", F.lit(2)) == 0))
    rate = F.when(low, F.lit("0.0001")).otherwise(F.lit("0.001")).cast("decimal(10,8)")
    made = rows.select("k", "place", rate.alias("rate"), interval.alias("interval"))
    return made.select("k", (F.sum("interval").over(line) * 60_000 + ops.POLICY_START_MS).alias("t"), "rate", "interval")


@query("E18_cadence_episodes")
def episodes(spark, sf_dir):
    """Hourly episodes on a synthetic cadence over all settlements; completed, open and failing ones occur."""
    return ops.cadence_episodes(_episode_rows(spark, sf_dir))


@query("H4_compact_funding", with_views("settlements", sql=f"""with {TIMED}, parts as (select *, t // 31536000000 as part from iv)
  select k, count(*) as "rows", count(distinct part) as fragments, count(*) filter (step <= 0) as interval_mismatch from parts group by k"""))
def compact(spark, sf_dir):
    rows = _rows(spark, sf_dir).select("k", "t", "rate", "interval", F.floor(F.col("t") / 31_536_000_000).alias("fragment"))
    return ops.union_audit(maintenance.compact_fragments(rows, scratch(spark, "funding"), 100_000)).drop("duplicates")


# three fragments that take turns in each series, share keys and sometimes state a wrong interval
@query("H4_funding_union_audit", with_views("settlement_rows", sql="""with stated as (select k, t, id % 3 as fragment,
    coalesce((t - lag(t) over (partition by k order by t, id)) // 60000 + case when id % 5 = 0 then 60 else 0 end, 480)::bigint as interval from settlement_rows),
  line as (select *, lag(t) over (partition by k order by t, interval) as previous from stated)
  select k, count(*) as "rows", count(distinct fragment) as fragments, count(*) filter (t = previous) as duplicates,
    count(*) filter (t - previous <> interval * 60000) as interval_mismatch from line group by k"""))
def union_audit(spark, sf_dir):
    from pyspark.sql import Window

    step = F.floor((F.col("t") - F.lag("t").over(Window.partitionBy("k").orderBy("t", "id"))) / 60_000)
    step = F.when(F.pmod("id", F.lit(5)) == 0, step + 60).otherwise(step)
    rows = views.settlement_rows(spark, sf_dir).select("k", "t", "rate", F.coalesce(step, F.lit(480)).alias("interval"), F.pmod("id", F.lit(3)).alias("fragment"))
    return ops.union_audit(maintenance.compact_fragments(rows, scratch(spark, "funding"), 100_000))


# four datasets a year with an instrument each in turn: one has another schema in even years, one has rows of another's
# instruments too, one some intervals an hour off
@query("H5_funding_pair_candidates", with_views("settlements", sql="""with stated as (select k, t, id, t // 31536000000 as part, coalesce((t - lag(t) over (partition by k order by t)) // 60000, 480)::bigint as interval from settlements),
  tagged as (select part, k % 4 as dataset, k, t, interval + case when k % 4 = 3 and id % 400 = 0 then 60 else 0 end as interval from stated
    union all select part, 2, k, t, interval from stated where k % 4 = 1 and id % 300 = 0),
  sets as (select distinct part, dataset, case when dataset = 0 and part % 2 = 0 then 'v2' else 'v1' end as shape from tagged),
  pairs as (select x.part, x.dataset as a, y.dataset as b, x.shape = y.shape as alike from sets x join sets y on x.part = y.part and x.dataset < y.dataset),
  lined as (select p.part, a, b, k, t, interval, lag(t) over (partition by p.part, a, b, k order by t, interval) as previous from pairs p join tagged g on g.part = p.part and g.dataset in (a, b) where alike),
  problems as (select *, case when t = previous then 'duplicate' when t - previous <> interval * 60000 then 'interval' end as problem from lined),
  firsts as (select part, a, b, arg_min(problem, (k, t, problem)) as problem from problems where problem is not null group by part, a, b)
  select p.part, p.a, p.b, case when not alike then 'schema' else coalesce(problem, 'eligible') end as class from pairs p left join firsts f on f.part = p.part and f.a = p.a and f.b = p.b"""))
def pair_candidates(spark, sf_dir):
    from pyspark.sql import Window

    step = F.floor((F.col("t") - F.lag("t").over(Window.partitionBy("k").orderBy("t"))) / 60_000)
    stated = views.settlements(spark, sf_dir).select(F.floor(F.col("t") / 31_536_000_000).alias("part"), F.pmod("k", F.lit(4)).alias("dataset"), "k", "t", "id", F.coalesce(step, F.lit(480)).alias("interval"))
    late = (F.col("dataset") == 3) & (F.pmod("id", F.lit(400)) == 0)
    copies = stated.filter("dataset = 1 and id % 300 = 0").withColumn("dataset", F.lit(2).cast("long"))
    tagged = stated.withColumn("interval", F.col("interval") + F.when(late, 60).otherwise(0)).unionByName(copies)
    shape = F.when((F.col("dataset") == 0) & (F.pmod("part", F.lit(2)) == 0), "v2").otherwise("v1")
    return ops.pair_candidates(tagged.withColumn("shape", shape))
