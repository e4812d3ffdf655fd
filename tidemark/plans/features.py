"""Queries of rolling features on hour bars."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidemark.functions.times import HOUR
from tidemark.operators import features as ops
from tidemark.plans.registry import query
from tidemark.plans.sql import VIEWS, with_views
from tidemark.sources import views

W = 20
LONG = 100
BASE = """
base as (select *, lag(close) over w as prev_close, row_number() over w as n from hours window w as (partition by k order by t)),
ranged as (select *, greatest(high - low, abs(high - prev_close), abs(low - prev_close)) as true_range from base),
rolled as (
  select *, case when n >= {w} then avg(close) over f end as rolling_mid, case when n >= {w} then max(high) over f end as rolling_high,
         case when n >= {w} then min(low) over f end as rolling_low, case when n >= {w} then avg(true_range) over f end as rolling_atr,
         case when n >= {w} then avg(volume) over f end as rolling_volume_mean
  from ranged window f as (partition by k order by t rows between {back} preceding and current row)),
prior as (select *, lag(rolling_mid) over w as prior_mid, lag(rolling_high) over w as prior_high, lag(rolling_low) over w as prior_low
          from rolled window w as (partition by k order by t))
"""


def sql(select: str, w: int = W) -> str:
    return with_views("hours", sql="with " + BASE.strip().format(w=w, back=w - 1) + "\n" + select)


def _features(spark, sf_dir, w=W):
    return ops.features(views.hour_bars(spark, sf_dir), w)


@query("E1_previous_close", with_views("hours", sql="select k, t, lag(close) over (partition by k order by t) as prev_close from hours"))
def previous_close(spark, sf_dir):
    return views.hour_bars(spark, sf_dir).select("k", "t", ops.previous_close().alias("prev_close"))


@query("E2_true_range", sql("select k, t, true_range from ranged"))
def true_range(spark, sf_dir):
    return views.hour_bars(spark, sf_dir).withColumn("prev_close", ops.previous_close()).select("k", "t", ops.true_range().alias("true_range"))


for _name, _column in (("E3_rolling_mid", "rolling_mid"), ("E4_rolling_high", "rolling_high"), ("E5_rolling_low", "rolling_low"),
                       ("E6_rolling_atr", "rolling_atr"), ("E7_rolling_volume_mean", "rolling_volume_mean")):
    _sql = f"round({_column}, 6)" if _column not in ("rolling_high", "rolling_low") else _column

    def _run(spark, sf_dir, column=_column):
        value = F.round(column, 6) if column not in ("rolling_high", "rolling_low") else F.col(column)
        return _features(spark, sf_dir).select("k", "t", value.alias(column))

    query(_name, sql(f"select k, t, {_sql} as {_column} from rolled"))(_run)


@query("E4_long_window", sql("select k, t, rolling_high, rolling_low, round(rolling_mid, 6) as rolling_mid from rolled", LONG))
def long_window(spark, sf_dir):
    return _features(spark, sf_dir, LONG).select("k", "t", "rolling_high", "rolling_low", F.round("rolling_mid", 6).alias("rolling_mid"))


@query("E8_prior_values", sql("select k, t, round(prior_mid, 6) as prior_mid, prior_high, prior_low from prior"))
def prior(spark, sf_dir):
    return _features(spark, sf_dir).select("k", "t", F.round("prior_mid", 6).alias("prior_mid"), "prior_high", "prior_low")


@query("E9_range_position", sql("""select k, t, rolling_high - rolling_low as range_width,
  case when rolling_high - rolling_low > 0 then round((close - rolling_low)::double / (rolling_high - rolling_low), 6) end as range_position from prior"""))
def range_position(spark, sf_dir):
    return _features(spark, sf_dir).select("k", "t", "range_width", F.round("range_position", 6).alias("range_position"))


@query("E10_touches", sql("select k, t, coalesce(low <= prior_low, false) as lower_touch, coalesce(high >= prior_high, false) as upper_touch from prior"))
def touches(spark, sf_dir):
    return _features(spark, sf_dir).select("k", "t", "lower_touch", "upper_touch")


@query("E11_mid_crossing", sql("""select k, t, coalesce((prev_close <= prior_mid and close > prior_mid) or (prev_close >= prior_mid and close < prior_mid), false) as mid_crossing from prior"""))
def mid_crossing(spark, sf_dir):
    return _features(spark, sf_dir).select("k", "t", "mid_crossing")


CORE = (1_705_276_800_000, 1_705_881_600_000)  # a week in the middle of the events


@query("E12_core_with_halo", sql(f"select k, t, rolling_high, rolling_low, round(rolling_mid, 6) as rolling_mid, prior_high from prior where t >= {CORE[0]} and t < {CORE[1]}", 4))
def halo(spark, sf_dir):
    rows = ops.core_with_halo(views.hour_bars(spark, sf_dir), 4, *CORE, halo_ms=14 * 86_400_000)
    return rows.select("k", "t", "rolling_high", "rolling_low", F.round("rolling_mid", 6).alias("rolling_mid"), "prior_high")


@query("E_feature_build", sql("""select count(*) as n, sum(rolling_high)::bigint as high_sum, sum(rolling_low)::bigint as low_sum,
  count(*) filter (rolling_mid is null) as warmup, count(*) filter (high >= prior_high) as upper, count(*) filter (low <= prior_low) as lower from prior"""))
def feature_build(spark, sf_dir):
    return _features(spark, sf_dir).agg(
        F.count("*").alias("n"), F.sum("rolling_high").alias("high_sum"), F.sum("rolling_low").alias("low_sum"),
        F.count(F.when(F.col("rolling_mid").isNull(), 1)).alias("warmup"), F.count(F.when(F.col("upper_touch"), 1)).alias("upper"), F.count(F.when(F.col("lower_touch"), 1)).alias("lower"))


@query("L5_forward_excursion", with_views("hours", sql="""select k, t, case when count(*) over f = 6 then close - min(low) over f end as adverse,
  case when count(*) over f = 6 then max(high) over f - close end as favourable from hours
  window f as (partition by k order by t rows between 1 following and 6 following)"""))
def excursion(spark, sf_dir):
    return ops.forward_excursion(views.hour_bars(spark, sf_dir), 6).select("k", "t", "adverse", "favourable")


# instruments have too few hours for a long window: the hours of eight pools of instruments
POOLED = "pooled as (select k % 8 as k, t, price, event_id from ticks),\n" + VIEWS["hours"].replace("from ticks", "from pooled as ticks")


def _pooled(spark, sf_dir):
    return views.bars(views.ticks(spark, sf_dir).withColumn("k", F.pmod("k", F.lit(8))), HOUR)


@query("L5_long_excursion", with_views("ticks", sql=f"""with {POOLED} select k, t, case when count(*) over f = {LONG} then close - min(low) over f end as adverse,
  case when count(*) over f = {LONG} then max(high) over f - close end as favourable from hours
  window f as (partition by k order by t rows between 1 following and {LONG} following)"""))
def long_excursion(spark, sf_dir):
    return ops.forward_excursion(_pooled(spark, sf_dir), LONG).select("k", "t", "adverse", "favourable")


@query("E4_pooled_window", with_views("ticks", sql=f"""with {POOLED} select k, t, case when count(*) over f = {LONG} then max(high) over f end as rolling_high,
  case when count(*) over f = {LONG} then min(low) over f end as rolling_low, case when count(*) over f = {LONG} then round(avg(close) over f, 6) end as rolling_mid from hours
  window f as (partition by k order by t rows between {LONG - 1} preceding and current row)"""))
def pooled_window(spark, sf_dir):
    return ops.features(_pooled(spark, sf_dir), LONG).select("k", "t", "rolling_high", "rolling_low", F.round("rolling_mid", 6).alias("rolling_mid"))


@query("L1_decision_time", with_views("bars", sql="select k, t, (t + 60000) * 1000000 as decision_ns from bars"))
def decision(spark, sf_dir):
    from tidemark.functions.times import decision_time_ns

    return views.minute_bars(spark, sf_dir).select("k", "t", decision_time_ns(F.col("t")).alias("decision_ns"))


# instruments whose customer has a negative balance, or none, have no metadata here
@query("L2_feature_status", sql(f"""select p.k, p.t, case when n < {W} then 'warmup' else '' end || case when t - lag(t) over w > 3600000 then '|missing' else '' end
    || case when c.c_custkey is null then '|metadata' else '' end as status
  from prior p left join (select c_custkey from customer where c_acctbal >= 0) c on p.k = c.c_custkey + 1 window w as (partition by p.k order by p.t)"""))
def status(spark, sf_dir):
    from pyspark.sql import Window

    line = Window.partitionBy("k").orderBy("t")
    warm = F.when(F.row_number().over(line) < W, F.lit("warmup")).otherwise(F.lit(""))
    gap = F.when(F.col("t") - F.lag("t").over(line) > 3_600_000, F.lit("|missing")).otherwise(F.lit(""))
    known = views.table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select((F.col("c_custkey") + 1).alias("k"), F.lit("").alias("known"))
    marked = views.hour_bars(spark, sf_dir).select("k", "t", F.concat(warm, gap).alias("status"))
    return marked.join(known, "k", "left").select("k", "t", F.concat("status", F.coalesce("known", F.lit("|metadata"))).alias("status"))


@query("L3_range_candidates", sql("""select k, t, rolling_high - rolling_low > 2000 as wide_enough, close between rolling_low and rolling_high as inside,
  sha256('{"high":"' || rolling_high || '","k":"' || k || '","low":"' || rolling_low || '","t":"' || t || '"}') as candidate_id from prior where rolling_high is not null"""))
def candidates(spark, sf_dir):
    from tidemark.functions.exact import row_digest

    rows = _features(spark, sf_dir).filter(F.col("rolling_high").isNotNull()).withColumns({"high": F.col("rolling_high"), "low": F.col("rolling_low")})
    return rows.select("k", "t", (F.col("range_width") > 2000).alias("wide_enough"), F.col("close").between(F.col("rolling_low"), F.col("rolling_high")).alias("inside"),
                       row_digest("k", "t", "high", "low").alias("candidate_id"))


FOLDS = (1_705_276_800_000, 1_706_140_800_000)  # where validation and test begin
HORIZON, EMBARGO = 6 * 3_600_000, 12 * 3_600_000


@query("L4_split_roles", with_views("hours", sql=f"""select k, t, case when t >= {FOLDS[1]} then case when t < {FOLDS[1] + EMBARGO} then 'embargo' else 'test' end
  when t >= {FOLDS[0]} then case when t < {FOLDS[0] + EMBARGO} then 'embargo' when t + {HORIZON} >= {FOLDS[1]} then 'purged' else 'validation' end
  else case when t + {HORIZON} >= {FOLDS[0]} then 'purged' else 'train' end end as role from hours"""))
def split_roles(spark, sf_dir):
    t = F.col("t")
    late = F.when(t < FOLDS[1] + EMBARGO, "embargo").otherwise("test")
    middle = F.when(t < FOLDS[0] + EMBARGO, "embargo").when(t + HORIZON >= FOLDS[1], "purged").otherwise("validation")
    early = F.when(t + HORIZON >= FOLDS[0], "purged").otherwise("train")
    return views.hour_bars(spark, sf_dir).select("k", "t", F.when(t >= FOLDS[1], late).when(t >= FOLDS[0], middle).otherwise(early).alias("role"))


RULE = ops.RangeRule("wide-and-flat", W, 500, 30_000, 1500, (150, 850), 1, 2, 400, 1, 20 * 86_400_000, 5 * 86_400_000)
IDENTITY = {"contract": "range-candidate-v1", "dataset": "hours", "category": "linear"}


# instruments of customers without debts have metadata, launched at the start of the year or, every fifth, ten days later
@query("L3_all_filters", sql(f"""select k, t, decision_ns, warm, complete, known, height, height_in_atr, mid_zone, edges_touched, middle_crossed, horizontal, liquid,
    warm and complete and known and height and height_in_atr and mid_zone and edges_touched and middle_crossed and horizontal and liquid as accepted,
    concat_ws(',', case when not warm then 'warm' end, case when not complete then 'complete' end, case when not known then 'known' end, case when not height then 'height' end, case when not height_in_atr then 'height_in_atr' end,
      case when not mid_zone then 'mid_zone' end, case when not edges_touched then 'edges_touched' end, case when not middle_crossed then 'middle_crossed' end, case when not horizontal then 'horizontal' end,
      case when not liquid then 'liquid' end) as rejections,
    sha256('{{"category":"linear","contract":"range-candidate-v1","dataset":"hours","decision_ns":"' || decision_ns || '","k":"' || k || '","rule":"{RULE.name}","rule_sha256":"{RULE.digest()}"}}') as candidate_id
  from (select k, t, (t + 60000) * 1000000 as decision_ns, drift is not null as warm, coalesce(span <= {RULE.most_span_ms}, false) as complete, coalesce(t - launch >= {RULE.least_age_ms}, false) as known,
    coalesce(width * 10000 >= rolling_mid * {RULE.least_height_bps} and width * 10000 <= rolling_mid * {RULE.most_height_bps}, false) as height,
    coalesce(width > 0 and width * 1000 >= rolling_atr * {RULE.least_atr_milli}, false) as height_in_atr,
    coalesce(width > 0 and (close - rolling_low) * 1000 between width * {RULE.zone_milli[0]} and width * {RULE.zone_milli[1]}, false) as mid_zone,
    coalesce(least(lower, upper) >= {RULE.touches} and n >= {W}, false) as edges_touched, coalesce(crossings >= {RULE.crossings} and n >= {W}, false) as middle_crossed,
    coalesce(abs(drift) * 1000 <= width * {RULE.most_drift_milli}, false) as horizontal, coalesce(rolling_volume_mean >= {RULE.least_volume}, false) as liquid
    from (select *, rolling_high - rolling_low as width, rolling_mid - lag(rolling_mid, {W}) over o as drift, t - lag(t, {W - 1}) over o as span, count(*) filter (low <= prior_low) over f as lower,
        count(*) filter (high >= prior_high) over f as upper, count(*) filter ((prev_close <= prior_mid and close > prior_mid) or (prev_close >= prior_mid and close < prior_mid)) over f as crossings
      from prior window o as (partition by k order by t), f as (partition by k order by t rows between {W - 1} preceding and current row)) p
    left join (select c_custkey + 1 as m, 1704067200000 + case when c_custkey % 5 = 0 then 864000000 else 0 end as launch from customer where c_acctbal >= 0) c on p.k = c.m)"""))
def all_filters(spark, sf_dir):
    late = F.when(F.pmod("c_custkey", F.lit(5)) == 0, 864_000_000).otherwise(0)
    metadata = views.table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select((F.col("c_custkey") + 1).alias("k"), (1_704_067_200_000 + late).alias("launch"))
    return ops.range_candidates(views.hour_bars(spark, sf_dir), RULE, metadata, IDENTITY)


DAY = 24 * HOUR
WALK = [ops.Fold(f"f{i}", 1_704_067_200_000 + 4 * i * DAY, 1_704_067_200_000 + (10 + 4 * i) * DAY, 1_704_067_200_000 + (14 + 4 * i) * DAY, 1_704_067_200_000 + (20 + 4 * i) * DAY) for i in range(3)]


# an outcome is known six bars later; every eleventh instrument is held out
@query("L4_walk_forward", with_views("hours", sql=f"""with o as (select k, t, lead(t, 6) over (partition by k order by t) as known_at from hours),
  folds as (select * from (values {", ".join(f"('{f.name}', {f.start}, {f.validation}, {f.test}, {f.end})" for f in WALK)}) as v(fold, a, b, c, d)),
  placed as (select k, t, known_at, fold, a, d, case when t >= c then 'test' when t >= b then 'validation' else 'train' end as own, case when t >= c then c when t >= b then b end as since, case when t >= c then d when t >= b then c else b end as until from o, folds)
  select k, t, fold, case when t < a or t >= d then 'outside' when k % 11 = 1 then 'held_out' when known_at is null then 'unresolved' when t < since + {EMBARGO} then 'embargo' when known_at >= until then 'purged' else own end as role from placed"""))
def walk_forward(spark, sf_dir):
    rows = views.hour_bars(spark, sf_dir).select("k", "t", F.lead("t", 6).over(Window.partitionBy("k").orderBy("t")).alias("known_at"))
    held = views.table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("k")).filter(F.pmod("k", F.lit(11)) == 1)
    return ops.split_roles(rows, WALK, EMBARGO, held)


@query("L6_outcome_metrics", with_views("hours", sql="""with moves as (select k, t, close - lag(close) over (partition by k order by t) as net from hours),
  net as (select *, row_number() over (partition by k order by t) - row_number() over (partition by k, net < 0 order by t) as run, row_number() over (partition by k order by net, t) as place,
          count(*) over (partition by k) as of_k from moves where net is not null),
  runs as (select k, max(c) as longest_losses from (select k, count(*) filter (net < 0) as c from net group by k, net < 0, run) group by k),
  months as (select k, max(gain) as best_month from (select k, date_trunc('month', epoch_ms(t)) as month, sum(case when net > 0 then net else 0 end)::bigint as gain from net group by all) group by k)
  select k, sum(net)::bigint as net_sum, count(*) as n, sum(case when net > 0 then net else 0 end)::bigint as gains, sum(case when net < 0 then -net else 0 end)::bigint as losses,
         quantile_disc(net, 0.05) as worst, round(sum(net)::double / count(*), 6) as expectancy,
         case when sum(case when net < 0 then -net else 0 end) > 0 then round(sum(case when net > 0 then net else 0 end)::double / sum(case when net < 0 then -net else 0 end), 6) end as profit_factor,
         round(avg(net) filter (place <= ceil(of_k * 0.01)), 6) as tail_mean, any_value(longest_losses) as longest_losses,
         case when sum(case when net > 0 then net else 0 end) > 0 then round(any_value(best_month)::double / sum(case when net > 0 then net else 0 end), 6) end as month_share
  from net join runs using (k) join months using (k) group by k"""))
def outcome_metrics(spark, sf_dir):
    hours = views.hour_bars(spark, sf_dir)
    line = Window.partitionBy("k").orderBy("t")
    return ops.outcome_metrics(hours.withColumn("net", F.col("close") - F.lag("close").over(line)).filter("net is not null"))
