"""Queries of summaries, distributions, throughput, projections and progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import profiles as ops
from tidemark.plans.registry import query
from tidemark.plans.sql import with_views
from tidemark.sources import views

RANGE = (1_704_240_000_000, 1_705_536_000_000)


@query("D1_single_symbol", with_views("bars", sql="select count(*) as n, min(t) as first_t, max(close) as max_close from bars where k = 7"))
def single_symbol(spark, sf_dir):
    return views.bars(views.ticks(spark, sf_dir).filter("k = 7")).agg(F.count("*").alias("n"), F.min("t").alias("first_t"), F.max("close").alias("max_close"))


@query("D2_universe_range", with_views("bars", sql=f"select count(*) as n, min(low) as low, max(high) as high from bars where t >= {RANGE[0]} and t < {RANGE[1]}"))
def universe_range(spark, sf_dir):
    rows = views.ticks(spark, sf_dir).filter((F.col("t") >= RANGE[0]) & (F.col("t") < RANGE[1]))  # whole minutes: ticks outside make no bar inside
    return views.bars(rows).agg(F.count("*").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


@query("D3_logical_summary", with_views("bars", sql="""select count(*) as n, min(t) as first_t, max(t) as last_t, sum(k)::bigint as ids, sum(open)::bigint as opens, sum(high)::bigint as highs, sum(low)::bigint as lows,
  sum(close)::bigint as closes, sum(volume)::bigint as volumes, sum(turnover)::bigint as turnovers from bars"""))
def logical_summary(spark, sf_dir):
    return ops.logical_summary(views.minute_bars(spark, sf_dir))


@query("D10_value_distribution", with_views("bars", sql="""select k, count(distinct close) as closes, min(low) as low, max(high) as high, min(volume) as min_volume, max(volume) as max_volume, min(turnover) as min_turnover,
  max(turnover) as max_turnover, max(high) * 10000 // min(low) as dynamic_range, count(*) filter (close % 100 = 0) as whole, max(length(regexp_replace(lpad((close % 100)::varchar, 2, '0'), '0+$', ''))) as places from bars group by k"""))
def distribution(spark, sf_dir):
    return ops.value_distribution(views.minute_bars(spark, sf_dir))


@query("D11_latency_percentiles", """select event_type, count(*) as n, quantile_disc(round(value * 100)::bigint, 0.5) as p50, quantile_disc(round(value * 100)::bigint, 0.95) as p95, quantile_disc(round(value * 100)::bigint, 0.99) as p99,
  min(round(value * 100)::bigint) as low, max(round(value * 100)::bigint) as high from events group by event_type""")
def latency(spark, sf_dir):
    return ops.percentiles(views.ticks(spark, sf_dir).withColumnRenamed("kind", "event_type"), "event_type", "price")


@query("D12_stage_throughput", with_views("ticks", sql="""select t // 86400000 as stage, count(*) as attempts, count(*) filter (kind <> 'error') as successes, count(*) filter (kind = 'error') as errors, max(t) - min(t) as span_ms,
  count(*) * 60000 // greatest(max(t) - min(t), 1) as per_minute from ticks group by 1"""))
def throughput(spark, sf_dir):
    return ops.stage_throughput(views.ticks(spark, sf_dir).withColumn("stage", F.floor(F.col("t") / 86_400_000)))


@query("D12_stage_status", with_views("ticks", sql="""with log as (select k as stage, t, case when kind = 'error' or price % 97 = 0 then 'E' || price % 3 end as code, price % 10 as rows from ticks),
  plans as (select c_custkey + 1 as stage, 3 + c_custkey % 5 as target from customer),
  c as (select stage, string_agg(code || ':' || n, ',' order by code) as errors from (select stage, code, count(*) as n from log where code is not null group by all) group by stage),
  s as (select stage, count(*) as attempts, count(*) filter (code is null) as successes, coalesce(sum("rows") filter (code is null), 0)::bigint as "rows", greatest(max(t) - min(t), 1) as span from log group by stage),
  m as (select p.stage, coalesce(attempts, 0) + (p.stage % 6 = 0)::int as planned, coalesce(attempts, 0) as attempts, coalesce(successes, 0) as successes, coalesce("rows", 0) as "rows", coalesce(errors, '') as errors,
    attempts * 60000000000 // (span * (case when p.stage % 2 = 0 then 1 else target * 1000 end)) as attainment from plans p left join s on s.stage = p.stage left join c on c.stage = p.stage)
  select *, case when attempts <> planned or successes <> planned or errors <> '' then 'failed' when attainment >= @ATTAINED then 'passed' else 'under_target' end as status from m""".replace("@ATTAINED", str(ops.ATTAINED))))
def stage_status(spark, sf_dir):
    code = F.when((F.col("kind") == "error") | (F.pmod("price", F.lit(97)) == 0), F.concat(F.lit("E"), F.pmod("price", F.lit(3)).cast("string")))
    log = views.ticks(spark, sf_dir).select(F.col("k").alias("stage"), "t", code.alias("code"), F.pmod("price", F.lit(10)).alias("rows"))
    made = log.groupBy("stage").agg(F.count("*").alias("made"))
    stages = views.table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("stage"), (F.pmod("c_custkey", F.lit(5)) + 3).alias("x"))
    planned = F.coalesce("made", F.lit(0)) + (F.pmod("stage", F.lit(6)) == 0).cast("long")
    plans = stages.join(made, "stage", "left").select("stage", planned.alias("planned"), F.when(F.pmod("stage", F.lit(2)) == 0, 1).otherwise(F.col("x") * 1000).alias("target"))
    return ops.stage_status(log, plans)


HORIZON = (820_454_400_000, 978_307_200_000)


@query("D13_backfill_estimate", with_views("settlements", sql=f"""with life as (select k, min(t) as launch, max(t) as last from settlements group by k),
  o as (select k, greatest((least(last, {HORIZON[1]}) - greatest(launch, {HORIZON[0]})) // 60000 + 1, 0) as minutes from life)
  select k, minutes::bigint as minutes, ((minutes + 999) // 1000)::bigint as pages, ((minutes + 479) // 480)::bigint as events from o"""))
def backfill(spark, sf_dir):
    life = views.settlements(spark, sf_dir).groupBy("k").agg(F.min("t").alias("launch"), F.max("t").alias("last"))
    return ops.backfill_estimate(life, *HORIZON)


@query("D14_storage_projection", with_views("bars", sql="""with p as (select k % 8 as bucket, count(*) as n, sum(turnover)::bigint as bytes from bars group by 1)
  select bucket, n, bytes, ((bytes::hugeint * 3650000 + n - 1) // n)::bigint as projected, ((bytes::hugeint * 3650000 + n - 1) // n) <= 60000000000 as fits from p"""))
def projection(spark, sf_dir):
    sizes = views.minute_bars(spark, sf_dir).groupBy(F.pmod("k", F.lit(8)).alias("bucket")).agg(F.count("*").alias("n"), F.sum("turnover").alias("bytes"))
    return ops.storage_projection(sizes, 3_650_000, 60_000_000_000)


@query("D16_progress", with_views("ticks", sql="""with j as (select k % 5 as campaign, t, kind = 'purchase' as done from ticks), m as (select max(t) as now from ticks),
  s as (select campaign, count(*) as total, count(*) filter (done) as complete, count(*) filter (done and t > now - 86400000) as recent from j, m group by campaign)
  select campaign, total, complete, complete * 1000000 // total as millionths, case when complete = total then 'complete' else 'running' end as status, recent,
    case when recent > 0 then ((total - complete) * 86400 + recent - 1) // recent end as eta_s from s"""))
def progress(spark, sf_dir):
    jobs = views.ticks(spark, sf_dir).select(F.pmod("k", F.lit(5)).alias("campaign"), "t", (F.col("kind") == "purchase").alias("done"))
    return ops.progress(jobs, 86_400_000)


@query("D18_layout_rank", """with l as (select p_brand as layout, p_size % 4 as buckets, sum(round(p_retailprice * 100)::bigint)::bigint as bytes, count(*) as files from part group by 1, 2)
  select buckets, arg_min(layout, (bytes, files, layout)) as best, min(bytes) as bytes from l group by buckets""")
def layout_rank(spark, sf_dir):
    part = views.table(spark, sf_dir, "part")
    layouts = part.groupBy(F.col("p_brand").alias("layout"), F.pmod("p_size", F.lit(4)).alias("buckets")).agg(F.sum(F.round(F.col("p_retailprice") * 100).cast("long")).alias("bytes"), F.count("*").alias("files"))
    return layouts.groupBy("buckets").agg(F.min_by("layout", F.struct("bytes", "files", "layout")).alias("best"), F.min("bytes").alias("bytes"))


# campaigns 5 and 6 have all jobs done by then, 6 is signed off; no job of 4 is; jobs of the others may complete after NOW
NOW, WINDOW_MS = 931_000_000_000, 30 * 86_400_000
CAMPAIGNS = f"""given as (select o_orderkey % 7 as campaign, o_orderkey as job, 1000 + o_orderkey % 9 * 1000 as pages, o_custkey as "rows", epoch_us(o_orderdate) // 1000 as t, 1 + round(o_totalprice * 100)::bigint % 5000000 as took, o_orderstatus as s from orders),
jobs as (select campaign, job, pages, "rows", case when job % 11 > 0 then t end as started,
  case when campaign > 4 then least(t + took, {NOW} - job % 1000000) when campaign < 4 and s <> 'P' and t + took <= {NOW} then t + took end as completed from given),
ordered as (select *, coalesce(completed >= {NOW - WINDOW_MS}, false) as recent, row_number() over (partition by campaign, coalesce(completed >= {NOW - WINDOW_MS}, false) order by completed, job) as place,
  count(*) over (partition by campaign, coalesce(completed >= {NOW - WINDOW_MS}, false)) as of_kind from jobs),
sums as (select campaign, count(*) as jobs, count(completed) as completed_jobs, sum(pages)::bigint as pages, coalesce(sum(pages) filter (completed is not null), 0)::bigint as completed_pages,
  coalesce(sum("rows") filter (completed is not null), 0)::bigint as completed_rows, max(completed) as last_completed, count(*) filter (recent and (place > 1 or of_kind = 1)) as sample_jobs,
  coalesce(sum(pages) filter (recent and (place > 1 or of_kind = 1)), 0)::bigint as sample_pages,
  coalesce(max(case when of_kind = 1 then completed - started else {NOW} - completed end) filter (recent and place = 1), 0)::bigint as sample_ms from ordered group by campaign),
rated as (select *, pages - completed_pages as pending_pages, case when sample_pages > 0 and sample_ms > 0 then sample_pages * 1000000 // sample_ms end as rate_milli from sums),
campaigns as (select campaign, jobs, completed_jobs, pages, completed_pages, pending_pages, completed_rows, last_completed, ({NOW} - last_completed) // 1000 as age_s, completed_pages * 1000000 // pages as millionths,
  case when campaign = 6 then 'complete' when completed_jobs = jobs then 'finalization-pending' when completed_jobs > 0 then 'in-progress' else 'not-started' end as status,
  sample_jobs, sample_pages, sample_ms, rate_milli, case when pending_pages = 0 then 0 when rate_milli > 0 then (pending_pages * 1000 + rate_milli - 1) // rate_milli end as eta_s from rated)"""


def _campaigns(spark, sf_dir):
    given = views.settlement_rows(spark, sf_dir).withColumn("campaign", F.pmod("id", F.lit(7)))
    status = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("s"))
    end = F.col("t") + 1 + F.pmod("rate", F.lit(5_000_000))
    completed = F.when(F.col("campaign") > 4, F.least(end, NOW - F.pmod("id", F.lit(1_000_000)))).when((F.col("campaign") < 4) & (F.col("s") != "P"), end)
    jobs = given.join(status, "id").select("campaign", F.col("id").alias("job"), (1000 + F.pmod("id", F.lit(9)) * 1000).alias("pages"), (F.col("k") - 1).alias("rows"),
                                           F.when(F.pmod("id", F.lit(11)) > 0, F.col("t")).alias("started"), completed.alias("completed"))
    return ops.campaign_progress(jobs, jobs.filter("campaign = 6").select("campaign"), NOW, WINDOW_MS)


@query("D16_campaigns", f"with {CAMPAIGNS} select * from campaigns")
def campaigns(spark, sf_dir):
    return _campaigns(spark, sf_dir)


@query("D16_total", f"""with {CAMPAIGNS} select count(*) as campaigns, count(*) filter (status <> 'complete') as pending_campaigns, sum(jobs)::bigint as jobs, sum(completed_jobs)::bigint as completed_jobs, sum(pages)::bigint as pages,
  sum(completed_pages)::bigint as completed_pages, sum(pending_pages)::bigint as pending_pages, sum(completed_pages)::bigint * 1000000 // sum(pages)::bigint as millionths,
  case when count(*) filter (status <> 'complete' and eta_s is null) = 0 then max(eta_s) filter (status <> 'complete') end as eta_s from campaigns where campaign <> 4""")
def total(spark, sf_dir):
    return ops.progress_total(_campaigns(spark, sf_dir).filter("campaign <> 4"))  # 4 never started and would leave the total without an estimate


@query("D16_total_unknown", f"with {CAMPAIGNS} select count(*) as campaigns, sum(pending_pages)::bigint as pending_pages, case when count(*) filter (status <> 'complete' and eta_s is null) = 0 then max(eta_s) filter (status <> 'complete') end as eta_s from campaigns")
def total_unknown(spark, sf_dir):
    return ops.progress_total(_campaigns(spark, sf_dir)).select("campaigns", "pending_pages", "eta_s")


# the least figures tie often: 50 bytes a step, and times of a few milliseconds
@query("D18_layout_shortlist", """with runs as (select case l_linenumber % 3 when 0 then 4 when 1 then 8 else 16 end as buckets, l_returnflag as "numeric", 'z' || l_partkey % 5 as compression, 16 * (1 + l_suppkey % 3) as target_mb, count(*) % 5 > 0 as verified,
    max(round(l_extendedprice * 100)::bigint) * 5 as largest, count(*) // 50 * 50 as bytes, sum(l_quantity)::bigint % 3 as write_ms, count(distinct l_shipdate) % 2 as first_ms, sum(l_linenumber)::bigint % 2 as warm_ms, count(distinct l_suppkey) % 4 as files
    from lineitem group by 1, 2, 3, 4),
  fit as (select *, first_ms + warm_ms as scan_ms, row_number() over (partition by buckets order by bytes, write_ms, first_ms + warm_ms, files, "numeric", compression, target_mb) as place, count(*) over (partition by buckets) as eligible
    from runs where verified and largest * 10 >= target_mb * 8 * 1048576 and buckets in (4, 8))
  select buckets, eligible, bytes, write_ms, scan_ms, files, "numeric", compression, target_mb from fit where place = 1""")
def layout_shortlist(spark, sf_dir):
    line = F.pmod("l_linenumber", F.lit(3))
    keys = [F.when(line == 0, 4).when(line == 1, 8).otherwise(16).alias("buckets"), F.col("l_returnflag").alias("numeric"), F.concat(F.lit("z"), F.pmod("l_partkey", F.lit(5)).cast("string")).alias("compression"), (16 * (1 + F.pmod("l_suppkey", F.lit(3)))).alias("target_mb")]
    runs = views.table(spark, sf_dir, "lineitem").groupBy(*keys).agg(
        (F.count("*") % 5 > 0).alias("verified"), (F.max(F.round(F.col("l_extendedprice") * 100).cast("long")) * 5).alias("largest"), F.expr("count(*) div 50 * 50").alias("bytes"),
        F.expr("cast(sum(l_quantity) as bigint) % 3").alias("write_ms"), F.expr("count(distinct l_shipdate) % 2").alias("first_ms"), F.expr("sum(l_linenumber) % 2").alias("warm_ms"), F.expr("count(distinct l_suppkey) % 4").alias("files"))
    return ops.shortlist_layouts(runs, ["first_ms", "warm_ms"])
