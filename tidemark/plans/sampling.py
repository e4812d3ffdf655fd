"""Queries of rankings and even samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import sampling as ops
from tidemark.operators.ranks import exact_quantiles
from tidemark.plans.registry import query
from tidemark.plans.sql import with_views
from tidemark.sources import views


def _liquid(spark, sf_dir):
    return views.instruments(spark, sf_dir).join(views.tickers(spark, sf_dir).select("symbol", "turnover", "low", "high"), "symbol")


@query("F1_liquid_price_sample", with_views("instruments", "tickers", sql="""with c as (select i.k, i.symbol, i.price, t.turnover, row_number() over (order by t.turnover desc, i.symbol) as place, count(*) over () as n from instruments i join tickers t on i.symbol = t.symbol),
  p as (select *, row_number() over (order by price, symbol) - 1 as rank, count(*) over () as pool from c where place <= least(n, greatest(20, 50)))
  select k, symbol, price, rank from p where rank in (select i * (pool - 1) // 4 from range(5) r(i))"""))
def liquid_sample(spark, sf_dir):
    return ops.liquid_price_sample(_liquid(spark, sf_dir), 5, 20).select("k", "symbol", "price", "rank")


# the tables' ranges are many times the price, so the limit is 30 times it; spreads are up to 16 hundredths of a percent
@query("F2_shortlist", with_views("instruments", "tickers", sql="""with m as (select i.symbol, i.price, greatest(i.size * i.price, 50000) as minimum_order, t.turnover, t.low - t.low // 20 as a, t.high + t.high // 20 as b from instruments i join tickers t on i.symbol = t.symbol
    where i.price between 90000 and 180000 and greatest(i.size * i.price, 50000) <= 900000 and t.turnover >= 1000000 and t.low <= t.high and (i.k % 90 + i.k % 70) * 10000 <= 5 * i.price and (t.high - t.low) * 1000 <= 30000 * i.price),
  r as (select symbol, minimum_order, turnover, a - a % 25 as lower, case when b % 25 = 0 then b else b - b % 25 + 25 end as upper from m),
  w as (select *, lower - lower // 20 as c, upper + upper // 20 as d from r), f as (select symbol, minimum_order, turnover, c - c % 25 as stop, lower, upper, case when d % 25 = 0 then d else d - d % 25 + 25 end as take from w)
  select * from f where 0 < stop and stop < lower and lower < upper and upper < take order by minimum_order, turnover desc, symbol limit 25"""))
def shortlist(spark, sf_dir):
    quoted = _liquid(spark, sf_dir).withColumns({"bid": F.col("price") - F.pmod("k", F.lit(90)), "ask": F.col("price") + F.pmod("k", F.lit(70))})
    return ops.shortlist(quoted, 25, range_permille=30_000)


@query("F3_even_rank_sample", with_views("instruments", sql="""with r as (select k, symbol, row_number() over (order by symbol) - 1 as rank, count(*) over () as n from instruments)
  select k, symbol, rank from r where rank in (select i * (n - 1) // 8 from range(9) t(i))"""))
def even_sample(spark, sf_dir):
    return ops.even_rank_sample(views.instruments(spark, sf_dir).select("k", "symbol"), ["symbol"], 9)


MATURE = 850_000_000_000


@query("F4_oldest_n", with_views("settlements", "instruments", sql=f"""with life as (select k, min(t) as launch from settlements group by k),
  records as (select symbol, case when size % 10 = 0 then 'LinearFutures' else 'LinearPerpetual' end as contract, case when price % 7 = 0 then 'USDC' else 'USDT' end as quote,
    case when i.k % 5 = 0 then 'Settled' else 'Trading' end as status, launch from instruments i left join life l on i.k = l.k)
  select symbol, launch from records where contract = 'LinearPerpetual' and quote = 'USDT' and status = 'Trading' and launch between 0 and {MATURE - 1999 * 60_000} order by launch, symbol limit 25"""))
def oldest(spark, sf_dir):
    life = views.settlements(spark, sf_dir).groupBy("k").agg(F.min("t").alias("launch"))
    records = views.instruments(spark, sf_dir).join(life, "k", "left").select(
        "symbol", F.when(F.pmod("size", F.lit(10)) == 0, "LinearFutures").otherwise("LinearPerpetual").alias("contract"), F.when(F.pmod("price", F.lit(7)) == 0, "USDC").otherwise("USDT").alias("quote"),
        F.lit("USDT").alias("settle"), F.when(F.pmod("k", F.lit(5)) == 0, "Settled").otherwise("Trading").alias("status"), "launch")
    return ops.oldest_instruments(records, 25, MATURE, 2)


# every fifth instrument is probed for half a day only, so its launch window ends it
@query("F7_probe_windows", with_views("settlements", sql="""with targets as (select k, min(t) as start, case when k % 5 = 0 then min(t) + 43200000 else max(t) end as stop from settlements group by k),
  launch as (select k, start, stop, least(stop, start + 999 * 60000) as launch_end from targets),
  annual as (select k, s as start, least(stop, s + 604800000 - 60000) as stop, stop as target_stop from (select k, unnest(generate_series(start + 31536000000, stop, 31536000000)) as s, stop from targets)),
  ends as (select l.*, (select max(a.stop) from annual a where a.k = l.k) as annual_end from launch l),
  windows as (select k, 'launch' as kind, start, launch_end as stop from launch union all select k, 'annual', start, stop from annual
    union all select k, 'terminal', greatest(launch_end + 60000, stop - 604800000 + 60000), stop from ends where launch_end < stop and (annual_end is null or annual_end < stop))
  select w.k, w.kind, w.start, w.stop, count(s.t) as observed, min(s.t) as first_t, (min(s.t) - w.start)::bigint as delay_ms
  from windows w left join settlements s on s.k = w.k and s.t between w.start and w.stop group by w.k, w.kind, w.start, w.stop"""))
def probes(spark, sf_dir):
    rows = views.settlements(spark, sf_dir)
    life = rows.groupBy("k").agg(F.min("t").alias("start"), F.max("t").alias("last"))
    targets = life.select("k", "start", F.when(F.pmod("k", F.lit(5)) == 0, F.col("start") + 43_200_000).otherwise(F.col("last")).alias("stop"))
    return ops.probe_results(ops.probe_windows(targets), rows)


@query("D11_exact_quantiles", with_views("ticks", sql="""select kind, f as fraction, list_sort(list(price))[greatest(ceil(f * count(*)), 1)::bigint] as price
  from ticks, (values (0.05::double), (0.5::double), (0.9::double), (0.99::double)) q(f) group by kind, f"""))
def quantiles(spark, sf_dir):
    return exact_quantiles(views.ticks(spark, sf_dir), "kind", "price", (0.05, 0.5, 0.9, 0.99))
