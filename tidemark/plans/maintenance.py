"""Queries of compaction, repair plans and their outcomes."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidemark.functions.times import DAY
from tidemark.operators import maintenance as ops, profiles
from tidemark.plans.catalog import BAR_SCHEMA, scratch, stored_bars
from tidemark.plans.coverage import COVERAGE_SQL, GAPS, _coverage, _gaps
from tidemark.plans.registry import query
from tidemark.plans.sql import with_views
from tidemark.sources import canonical, views
from tidemark.sources.shared import checkpoints

SUMMARY = """select count(*) as n, min(t) as first_t, max(t) as last_t, sum(k)::bigint as ids, sum(open)::bigint as opens, sum(high)::bigint as highs, sum(low)::bigint as lows,
  sum(close)::bigint as closes, sum(volume)::bigint as volumes, sum(turnover)::bigint as turnovers from bars"""


@query("H1_compact_candles", with_views("bars", sql=SUMMARY))
def compact(spark, sf_dir):
    path = scratch(spark, "compacted")
    ops.compact(stored_bars(spark, sf_dir), path, 100_000, ["year", "month", "bucket"])
    return profiles.logical_summary(spark.read.parquet(path))


# buckets 0 to 3 are stored in several small files each, the others in one
@query("H1_incremental_compaction", with_views("bars", sql="""select k % 8 as bucket, count(*) as n, sum(close)::bigint as closes, count(distinct (k, t)) as keys, k % 8 < 4 as rewritten, true as kept_or_fell
  from bars where k % 8 in (select bucket from (select k % 8 as bucket, count(distinct t // 86400000 % 5) as days from bars group by 1) where bucket >= 4 or days > 1) group by 1"""))
def compact_incrementally(spark, sf_dir):
    path = scratch(spark, "fragmented")
    checkpoints(spark)
    bars = canonical.partition_columns(views.minute_bars(spark, sf_dir).select(*BAR_SCHEMA.names))
    piece = F.when(F.col("bucket") < 4, F.pmod(F.floor(F.col("t") / DAY), F.lit(5))).otherwise(0)
    for number in range(5):
        bars.filter(piece == number).repartition(*canonical.PARTITIONS).write.partitionBy(*canonical.PARTITIONS).mode("append").parquet(path)
    before = ops.file_sizes(canonical.read_canonical(spark, path, BAR_SCHEMA)).checkpoint()
    plan = ops.compact_partitions(canonical.read_canonical(spark, path, BAR_SCHEMA), path)
    spark.catalog.refreshByPath(path)
    after = ops.file_sizes(canonical.read_canonical(spark, path, BAR_SCHEMA))
    counts = before.groupBy("bucket").agg(F.collect_set("file").alias("before")).join(after.groupBy("bucket").agg(F.collect_set("file").alias("after")), "bucket")
    same = F.size(F.array_except("before", "after")) == 0
    fell = F.size("after") < F.size("before")
    state = counts.join(plan.groupBy("bucket").agg(F.bool_or("worthwhile").alias("rewritten")), "bucket")
    state = state.select("bucket", "rewritten", F.when(F.col("rewritten"), fell).otherwise(same).alias("kept_or_fell"))
    rows = canonical.read_canonical(spark, path, BAR_SCHEMA).groupBy("bucket").agg(F.count("*").alias("n"), F.sum("close").alias("closes"), F.countDistinct("k", "t").alias("keys"))
    return rows.join(state, "bucket")


@query("H1_compaction_plan", with_views("bars", sql="""with f as (select t // 86400000 % 8 as part, t // 86400000 as file, count(*) as n from bars group by 1, 2)
  select part, count(*) as files, sum(n)::bigint as "rows", ((sum(n) + 999) // 1000)::bigint as new_files, (sum(n) + 999) // 1000 < count(*) as worthwhile from f group by part"""))
def plan(spark, sf_dir):
    day = F.floor(F.col("t") / 86_400_000)
    files = views.minute_bars(spark, sf_dir).groupBy(F.pmod(day, F.lit(8)).alias("part"), day.alias("file")).agg(F.count("*").alias("rows"))
    return ops.compaction_plan(files, 1000)


@query("H2_rows_per_file", with_views("bars", sql="""select k % 8 as bucket, count(*) as n, (ceil(16777216.0::double * count(*) / sum(turnover) / 128000) * 128000)::bigint as rows_per_file from bars group by 1"""))
def rows_per_file(spark, sf_dir):
    sample = views.minute_bars(spark, sf_dir).groupBy(F.pmod("k", F.lit(8)).alias("bucket")).agg(F.count("*").alias("n"), F.sum("turnover").alias("bytes"))
    return sample.select("bucket", "n", ops.rows_per_file(F.col("n"), F.col("bytes")).alias("rows_per_file"))


@query("H3_file_size_class", with_views("ticks", sql="""select k, sum(price * 20)::bigint as size, case when sum(price * 20) * 100 < 80 * 16777216 then 'tail' when sum(price * 20) * 100 <= 120 * 16777216 then 'target' else 'oversized' end as class from ticks group by k"""))
def size_class(spark, sf_dir):
    sizes = views.ticks(spark, sf_dir).groupBy("k").agg(F.sum(F.col("price") * 20).alias("size"))
    return sizes.select("k", "size", ops.file_size_class(F.col("size")).alias("class"))


EXPLAINED = f"""{GAPS}, sized as (select k, gap_start, gap_end, ((gap_end - gap_start) // 60000 + 1)::bigint as minutes from gaps),
explained as (select k, t + 60000 as t from bars where close % 5 = 0),
tasks as (select s.* from sized s where not exists (select 1 from explained e where e.k = s.k and e.t between s.gap_start and s.gap_end))"""


def _tasks(spark, sf_dir):
    explained = views.minute_bars(spark, sf_dir).filter(F.pmod("close", F.lit(5)) == 0).select("k", (F.col("t") + 60_000).alias("t"))
    return ops.plan_gap_repairs(_gaps(spark, sf_dir).drop("start", "stop"), explained, 1000, 10_000)


@query("H6_plan_gap_repairs", with_views("bars", sql=f"with {EXPLAINED} select k, gap_start, gap_end, minutes, ((minutes + 999) // 1000)::bigint as pages, minutes <= 10000 as within_limit from tasks"))
def plan_repairs(spark, sf_dir):
    return _tasks(spark, sf_dir)


REPAIR = """repair as (select k, t + 60000 as t, close from bars where k % 3 = 0)"""


@query("H7_apply_gap_repair", with_views("bars", sql=f"""with {REPAIR}, u as (select k, t, close, 'parent' as origin from bars union all select * , 'repair' from repair)
  select k, t, close, origin, count(distinct origin) over (partition by k, t) > 1 as overlap from u""".replace("count(distinct origin) over (partition by k, t) > 1", "min(origin) over (partition by k, t) <> max(origin) over (partition by k, t)")))
def apply_repair(spark, sf_dir):
    bars = views.minute_bars(spark, sf_dir)
    return ops.apply_repair(bars, bars.filter(F.pmod("k", F.lit(3)) == 0).select("k", (F.col("t") + 60_000).alias("t"), "close"))


# the repair fills the minutes between two ticks of every third instrument; the request of every fifth is a minute too long
COVERED = """line as (select k, t, lead(t) over (partition by k order by t) as next from bars), firsts as (select k, min(t) as start from bars where k % 7 > 0 group by k),
u as (select k, t from bars union all select k, unnest(range(t + 60000, least(next, t + 60000 * 600), 60000)) from line where k % 3 = 0 and next is not null),
near as (select u.k, u.t from u join firsts f on u.k = f.k where u.t <= f.start + 60000 * 5 or u.k % 11 = 0 union all select k, t from u where k % 7 = 0),
asked as (select k, start, start + 60000 * (5 + (k % 5 = 0)::int) as stop from firsts)"""


@query("H7_exact_coverage", with_views("bars", sql=f"""with {COVERED}
  select coalesce(n.k, a.k) as k, coalesce(max((stop - start) // 60000 + 1), 0) as expected, count(n.t) as n,
    coalesce(count(n.t) = count(distinct n.t) and count(distinct n.t) filter (n.t between start and stop and (n.t - start) % 60000 = 0) = max((stop - start) // 60000 + 1)
      and count(*) filter (n.t < start or n.t > stop) = 0, false) as exact
  from near n full join asked a on n.k = a.k group by 1"""))
def exact_coverage(spark, sf_dir):
    bars = views.minute_bars(spark, sf_dir)
    after = F.lead("t").over(Window.partitionBy("k").orderBy("t"))
    between = F.when(F.col("next") > F.col("t") + 60_000, F.sequence(F.col("t") + 60_000, F.least(F.col("next"), F.col("t") + 60_000 * 600) - 60_000, F.lit(60_000)))
    filled = bars.select("k", "t", after.alias("next")).filter("k % 3 = 0").select("k", F.explode(between).alias("t"))
    firsts = bars.filter("k % 7 > 0").groupBy("k").agg(F.min("t").alias("start"))
    table = bars.select("k", "t").unionByName(filled).join(firsts, "k", "left").filter("start is null or t <= start + 60000 * 5 or k % 11 = 0")
    asked = firsts.withColumn("stop", F.col("start") + 60_000 * (5 + (F.pmod("k", F.lit(5)) == 0).cast("long")))
    return ops.exact_coverage(table, asked)


@query("H8_repair_outcome", with_views("bars", sql=f"""with {EXPLAINED}, returned as (select distinct k, t + 60000 as t from bars union select distinct k, t + 120000 from bars)
  select t.k, t.gap_start, t.minutes, count(r.t) as returned, t.minutes - count(r.t) as missing, t.minutes = count(r.t) as passed
  from (select distinct * from tasks) t left join returned r on r.k = t.k and r.t between t.gap_start and t.gap_end group by t.k, t.gap_start, t.minutes"""))
def outcome(spark, sf_dir):
    bars = views.minute_bars(spark, sf_dir)
    returned = bars.select("k", F.explode(F.array(F.col("t") + 60_000, F.col("t") + 120_000)).alias("t"))
    return ops.repair_outcome(_tasks(spark, sf_dir), returned)


@query("H12_repair_classification", with_views("bars", sql=f"""with {COVERAGE_SQL} select k, missing, case when k % 4 = 3 then 'funding_separate' when passed then 'not_blocked' when duplicates + unexpected > 0 then 'ineligible_key_defects' when quarantined_missing > 0 then 'ineligible_quarantined'
  when excluded_missing > 0 then 'ineligible_excluded' else 'eligible' end as class from coverage"""))
def classification(spark, sf_dir):
    kind = F.when(F.pmod("k", F.lit(4)) == 3, "funding").otherwise("candles")
    return ops.repair_classification(_coverage(spark, sf_dir).withColumn("kind", kind)).select("k", "missing", "class")


@query("H13_fragment_and_rewrite", with_views("bars", sql=SUMMARY))
def fragment(spark, sf_dir):
    parts, whole = scratch(spark, "fragments"), scratch(spark, "rewritten")
    bars = views.minute_bars(spark, sf_dir)
    bars.withColumn("bucket", F.pmod("k", F.lit(8))).repartition(8, "t").write.partitionBy("bucket").parquet(parts)
    ops.compact(spark.read.parquet(parts), whole, 1_000_000, ["bucket"])
    return profiles.logical_summary(spark.read.parquet(whole))
