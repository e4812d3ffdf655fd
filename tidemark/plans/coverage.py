"""Queries of gaps and coverage on minute bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.times import DAY, HOUR, MINUTE
from tidemark.operators import gaps as ops
from tidemark.plans.registry import query
from tidemark.plans.sql import with_views
from tidemark.sources import views

REQUESTS = "requests as (select k, min(t) - 60000 as start, max(t) + 60000 as stop from bars group by k)"
# every third instrument has a second request that overlaps the first
GAPS = f"""first_{REQUESTS},
requests as (select * from first_requests union select k, start + 7200000, stop + 600000 from first_requests where k % 3 = 0),
seen as (select r.k, r.start, r.stop, b.t, coalesce(lag(b.t) over (partition by r.k, r.start, r.stop order by b.t), r.start - 60000) as before
  from bars b join requests r on b.k = r.k and b.t between r.start and r.stop),
gaps as (
  select k, start, stop, before + 60000 as gap_start, t - 60000 as gap_end from seen where t - before > 60000
  union all select r.k, r.start, r.stop, coalesce(max(b.t) + 60000, r.start), r.stop from requests r left join bars b on b.k = r.k and b.t between r.start and r.stop
  group by r.k, r.start, r.stop having coalesce(max(b.t) + 60000, r.start) <= r.stop)"""


def requests(bars):
    return bars.groupBy("k").agg((F.min("t") - MINUTE).alias("start"), (F.max("t") + MINUTE).alias("stop"))


def _both(spark, sf_dir):
    bars = views.minute_bars(spark, sf_dir)
    return requests(bars), bars


def _gaps(spark, sf_dir):
    first, bars = _both(spark, sf_dir)
    later = first.filter("k % 3 = 0").select("k", (F.col("start") + 2 * HOUR).alias("start"), (F.col("stop") + 10 * MINUTE).alias("stop"))
    return ops.gap_ranges(first.unionByName(later), bars)


@query("E13_gap_ranges", with_views("bars", sql=f"with {GAPS} select k, start, stop, gap_start, gap_end, ((gap_end - gap_start) // 60000 + 1)::bigint as minutes from gaps"))
def gap_ranges(spark, sf_dir):
    return _gaps(spark, sf_dir)


# beside each series an overlapping one for every other instrument, one that is whole, and one of an instrument without rows
@query("E14_gap_topology", with_views("bars", sql=f"""with first_{REQUESTS},
  requests as (select * from first_requests union select k, start + 600000, stop + 1200000 from first_requests where k % 2 = 0
    union select k, min(t), min(t) from bars where k % 3 = 0 group by k union select k + 1000000, start, stop from first_requests where k % 5 = 0),
  seen as (select r.*, b.t, coalesce(lag(b.t) over (partition by r.k, r.start, r.stop order by b.t), r.start - 60000) as before from requests r join bars b on b.k = r.k and b.t between r.start and r.stop),
  gaps as (select k, start, stop, before + 60000 as gap_start, t - 60000 as gap_end from seen where t - before > 60000
    union all select r.k, r.start, r.stop, coalesce(max(s.t) + 60000, r.start), r.stop from requests r left join seen s on s.k = r.k and s.start = r.start and s.stop = r.stop
    group by r.k, r.start, r.stop having coalesce(max(s.t) + 60000, r.start) <= r.stop),
  sized as (select *, (gap_end - gap_start) // 60000 + 1 as m, case when gap_start = start and gap_end = stop then 'absent' when gap_start = start then 'leading' when gap_end = stop then 'trailing' else 'internal' end as kind from gaps)
  select k, start, stop, coalesce(sum(m) filter (kind = 'absent'), 0)::bigint as absent_minutes, coalesce(sum(m) filter (kind = 'leading'), 0)::bigint as leading_minutes,
    coalesce(sum(m) filter (kind = 'trailing'), 0)::bigint as trailing_minutes, coalesce(sum(m) filter (kind = 'internal'), 0)::bigint as internal_minutes,
    count(*) filter (kind = 'absent') as absent_ranges, count(*) filter (kind = 'leading') as leading_ranges, count(*) filter (kind = 'trailing') as trailing_ranges,
    count(*) filter (kind = 'internal') as internal_ranges, coalesce(sum(m), 0)::bigint as missing
  from requests left join sized using (k, start, stop) group by k, start, stop"""))
def gap_topology(spark, sf_dir):
    first, bars = _both(spark, sf_dir)
    later = first.filter("k % 2 = 0").select("k", (F.col("start") + 600_000).alias("start"), (F.col("stop") + 1_200_000).alias("stop"))
    whole = bars.filter("k % 3 = 0").groupBy("k").agg(F.min("t").alias("start"), F.min("t").alias("stop"))
    absent = first.filter("k % 5 = 0").select((F.col("k") + 1_000_000).alias("k"), "start", "stop")
    return ops.gap_topology(first.unionByName(later).unionByName(whole).unionByName(absent), bars)


@query("F5_gap_examples", with_views("bars", sql=f"""with {GAPS}, ranked as (select *, row_number() over (partition by k, start, stop order by gap_start) as place from gaps)
  select k, start, stop, place, gap_start, gap_end from ranked where place <= 20"""))
def gap_examples(spark, sf_dir):
    from pyspark.sql import Window

    series = Window.partitionBy("k", "start", "stop")
    ranked = _gaps(spark, sf_dir).withColumn("place", F.row_number().over(series.orderBy("gap_start")).cast("long"))
    return ranked.filter("place <= 20").select("k", "start", "stop", "place", "gap_start", "gap_end")


@query("C4_missing_keys", with_views("hours", sql="""with requests as (select k, min(t) as start, max(t) as stop from hours group by k),
  expected as (select k, unnest(generate_series(start, stop, 3600000)) as t from requests)
  select e.k, e.t from expected e anti join hours h on e.k = h.k and e.t = h.t"""))
def missing_keys(spark, sf_dir):
    hours = views.hour_bars(spark, sf_dir)
    return ops.missing_keys(hours.groupBy("k").agg(F.min("t").alias("start"), F.max("t").alias("stop")), hours, 3_600_000)


# every other instrument has a second request that begins a day later, so rows lie outside; some rows are there two or three
# times, the source lacks some and has others, and some quarantined keys aren't missing
COVERED = """firsts as (select k, min(t) - 60000 as start, max(t) + 60000 as stop from bars group by k),
requests as (select * from firsts union all select k, start + 86400000, stop from firsts where k % 2 = 0 and start + 86400000 <= stop),
good as (select * from bars where high - low <= 20000 and close % 7 <> 0),
canonical as (select k, t from good union all select k, t from good where k % 3 = 0 and close % 5 = 0 union all select k, t from good where k % 3 = 0 and close % 10 = 0),
source as (select k, t from good where close % 11 <> 0 union select k, t + 60000 from good where close % 13 = 0),
quarantined as (select k, t from bars where high - low > 20000 or close % 17 = 0), excluded as (select k, t from bars where close % 7 = 0 and high - low <= 20000 and close % 17 <> 0)"""


def _coverage(spark, sf_dir):
    bars = views.minute_bars(spark, sf_dir)
    wide, odd = F.col("high") - F.col("low") > 20_000, F.pmod("close", F.lit(7)) == 0
    firsts = requests(bars)
    later = firsts.filter("k % 2 = 0").withColumn("start", F.col("start") + DAY).filter("start <= stop")
    good = bars.filter(~wide & ~odd)
    copies = F.when((F.pmod("k", F.lit(3)) == 0) & (F.pmod("close", F.lit(10)) == 0), 3).when((F.pmod("k", F.lit(3)) == 0) & (F.pmod("close", F.lit(5)) == 0), 2).otherwise(1)
    canonical = good.withColumn("copy", F.explode(F.array_repeat(F.lit(0), copies)))
    source = good.filter("close % 11 <> 0").select("k", "t").unionByName(good.filter("close % 13 = 0").select("k", (F.col("t") + MINUTE).alias("t")))
    marked = F.pmod("close", F.lit(17)) == 0
    return ops.coverage_by_series(firsts.unionByName(later), canonical, bars.filter(wide | marked), bars.filter(odd & ~wide & ~marked), source)


COVERAGE_SQL = f"""{COVERED},
per_key as (select k, t, count(*) as n from canonical group by k, t),
facts as (select coalesce(p.k, s.k) as k, n, s.k is not null as in_source from per_key p full join source s on p.k = s.k and p.t = s.t),
of_k as (select k, count(n) as keys, count(*) filter (n is null or not in_source) as source_mismatch from facts group by k),
counted as (select r.k, r.start, r.stop, count(p.n) as observed, coalesce(sum(p.n), 0)::bigint as row_count
  from requests r left join per_key p on p.k = r.k and p.t between r.start and r.stop group by r.k, r.start, r.stop),
explained as (select r.k, r.start, r.stop, count(*) filter (why = 'q') as quarantined_missing, count(*) filter (why = 'x') as excluded_missing
  from requests r join (select 'q' as why, * from quarantined union all select 'x', * from excluded) e on e.k = r.k and e.t between r.start and r.stop
  anti join per_key p on p.k = e.k and p.t = e.t group by r.k, r.start, r.stop),
coverage as (select k, start, stop, ((stop - start) // 60000 + 1)::bigint as expected, observed, row_count, row_count - observed as duplicates, coalesce(keys, 0) - observed as unexpected,
    coalesce(source_mismatch, 0) as source_mismatch, coalesce(quarantined_missing, 0) as quarantined_missing, coalesce(excluded_missing, 0) as excluded_missing,
    (stop - start) // 60000 + 1 - observed as missing, (stop - start) // 60000 + 1 - observed - coalesce(quarantined_missing, 0) - coalesce(excluded_missing, 0) as no_data,
    (stop - start) // 60000 + 1 = row_count and observed = row_count and coalesce(keys, 0) = observed and coalesce(source_mismatch, 0) = 0 as passed
  from counted left join of_k using (k) left join explained using (k, start, stop))"""


@query("D4_coverage_by_series", with_views("bars", sql=f"with {COVERAGE_SQL} select * from coverage"))
def coverage_by_series(spark, sf_dir):
    return _coverage(spark, sf_dir)


@query("D5_coverage_campaign", with_views("bars", sql=f"""with {COVERAGE_SQL}
  select k % 4 as kind, count(*) as series, sum(expected)::bigint as expected, sum(observed)::bigint as observed, sum(missing)::bigint as missing, sum(duplicates)::bigint as duplicates,
    sum(unexpected)::bigint as unexpected, bool_and(passed) as passed from coverage group by rollup(k % 4)"""))
def coverage_campaign(spark, sf_dir):
    return ops.coverage_campaign(_coverage(spark, sf_dir).withColumn("kind", F.pmod("k", F.lit(4))))


@query("D6_reason_counts", with_views("bars", sql=f"""with {COVERAGE_SQL}, reasons as (
    select 'quarantined' as reason, sum(quarantined_missing)::bigint as minutes from coverage union all select 'excluded', sum(excluded_missing)::bigint from coverage
    union all select 'no_data', sum(no_data)::bigint from coverage)
  select reason, minutes, (select sum(missing) from coverage) = sum(minutes) over () as balanced from reasons"""))
def reason_counts(spark, sf_dir):
    c = _coverage(spark, sf_dir).agg(*[F.sum(x).alias(x) for x in ("quarantined_missing", "excluded_missing", "no_data", "missing")])
    pairs = F.array(*[F.struct(F.lit(n).alias("reason"), F.col(v).alias("minutes")) for n, v in (("quarantined", "quarantined_missing"), ("excluded", "excluded_missing"), ("no_data", "no_data"))])
    balanced = F.col("missing") == F.col("quarantined_missing") + F.col("excluded_missing") + F.col("no_data")
    return c.select(F.explode(pairs).alias("p"), balanced.alias("balanced")).select("p.reason", "p.minutes", "balanced")


@query("E22_tiling_check", with_views("bars", sql="""with requests as (select k, min(t) // 86400000 * 86400000 as start, max(t) // 86400000 * 86400000 + 86340000 as stop from bars group by k),
  pages as (select k, t // 86400000 * 86400000 as page_start, t // 86400000 * 86400000 + 86340000 as page_end, count(*) as n from bars group by all),
  marked as (select *, lag(page_end) over (partition by k order by page_start) as prev from pages),
  sums as (select k, count(*) as pages, min(page_start) as lo, max(page_end) as hi, count(*) filter (page_start > prev + 60000) as holes,
    count(*) filter (page_start < prev + 60000) as "overlaps", count(*) filter (n = 0) as empty_pages from marked group by k)
  select k, pages, holes, "overlaps", empty_pages, holes = 0 and "overlaps" = 0 and lo = start and hi = stop as tiled from requests join sums using (k)"""))
def tiling_check(spark, sf_dir):
    bars = views.minute_bars(spark, sf_dir)
    day = F.col("t") - F.pmod("t", F.lit(DAY))
    pages = bars.groupBy("k", day.alias("page_start")).agg(F.count("*").alias("n")).withColumn("page_end", F.col("page_start") + DAY - MINUTE)
    wanted = bars.groupBy("k").agg(F.min(day).alias("start"), (F.max(day) + DAY - MINUTE).alias("stop"))
    return ops.tiling_check(pages, wanted)


INTERVALS = """intervals as (select k, t as start, t + (volume + 3) * 3600000 as stop from hours)"""
MERGED = INTERVALS + """, reached as (select *, max(stop) over (partition by k order by start, stop rows between unbounded preceding and 1 preceding) as reach from intervals),
  numbered as (select *, sum(case when reach is null or start > reach + 60000 then 1 else 0 end) over (partition by k order by start, stop) as island from reached),
  merged as (select k, min(start) as start, max(stop) as stop, count(*) as parts, count(*) filter (start <= reach) as overlaps from numbered group by k, island)"""


def _intervals(spark, sf_dir):
    hours = views.hour_bars(spark, sf_dir)
    return hours.select("k", F.col("t").alias("start"), (F.col("t") + (F.col("volume") + 3) * 3_600_000).alias("stop"))


@query("G6_merge_intervals", with_views("hours", sql=f"with {MERGED} select * from merged"))
def merge_intervals(spark, sf_dir):
    return ops.merge_intervals(_intervals(spark, sf_dir))


@query("G7_interval_sets_equal", with_views("hours", sql=f"""with {MERGED}, other as (select k, start, stop from merged where parts > 1)
  select k, start, stop, 'left' as side from merged where parts = 1"""))
def interval_sets(spark, sf_dir):
    merged = ops.merge_intervals(_intervals(spark, sf_dir))
    return ops.table_difference(merged.select("k", "start", "stop"), merged.filter("parts > 1").select("k", "start", "stop"))


@query("C3_lifecycle_check", with_views("bars", sql="""with life as (select k, min(t) + 86400000 as launch, case when k % 3 = 0 then max(t) - 86400000 end as delivery from bars group by k)
  select b.k, count(*) filter (t < launch) as before_launch, count(*) filter (t > delivery) as after_delivery, bool_and(t >= launch and (delivery is null or t <= delivery)) as inside
  from bars b join life l on b.k = l.k group by b.k"""))
def lifecycle_check(spark, sf_dir):
    bars = views.minute_bars(spark, sf_dir)
    life = bars.groupBy("k").agg((F.min("t") + DAY).alias("launch"), F.max("t").alias("last"))
    life = life.withColumn("delivery", F.when(F.pmod("k", F.lit(3)) == 0, F.col("last") - DAY))
    met = bars.join(life, "k")
    inside = (F.col("t") >= F.col("launch")) & (F.col("delivery").isNull() | (F.col("t") <= F.col("delivery")))
    return met.groupBy("k").agg(F.count(F.when(F.col("t") < F.col("launch"), 1)).alias("before_launch"), F.count(F.when(F.col("t") > F.col("delivery"), 1)).alias("after_delivery"), F.bool_and(inside).alias("inside"))


# pages of two bars: those of an hour with exactly two ticks, and the same with a bar a minute later put in
@query("E24_full_page_check", with_views("bars", sql="""with filled as (select k, t from bars union select k, t + 60000 from bars where close % 2 = 0 and t // 3600000 = (t + 60000) // 3600000),
  pages as (select k, t // 3600000 as page, t, row_number() over (partition by k, t // 3600000 order by t desc) as place from filled),
  marked as (select *, lag(t) over (partition by k, page order by place) as prev from pages)
  select k * 1000000 + page as page, count(*) as n, min(t) as first, max(t) as last, bool_and(prev is null or t = prev - 60000) and count(*) = 2 and count(distinct t) = 2 as "full" from marked group by k, page"""))
def full_pages(spark, sf_dir):
    from pyspark.sql import Window

    bars = views.minute_bars(spark, sf_dir).select("k", "t", "close")
    hour = F.floor(F.col("t") / HOUR)
    after = bars.filter((F.pmod("close", F.lit(2)) == 0) & (hour == F.floor((F.col("t") + MINUTE) / HOUR))).select("k", (F.col("t") + MINUTE).alias("t"))
    filled = bars.select("k", "t").unionByName(after).distinct()
    place = F.row_number().over(Window.partitionBy("k", hour).orderBy(F.col("t").desc()))
    return ops.page_shape(filled.select((F.col("k") * 1_000_000 + hour).alias("page"), place.alias("place"), "t"), 2)
