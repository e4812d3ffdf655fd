"""Queries of exact admission: decimals, violations, quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import exact, times
from tidemark.operators import admission as ops
from tidemark.plans.registry import query
from tidemark.plans.sql import with_views
from tidemark.sources import views

# prices and volumes as exact text of various scales, from the line items
TEXTS = """texts as (select l_orderkey, l_linenumber::bigint as line,
  (round(l_extendedprice * 100)::bigint // 100) || '.' || lpad((round(l_extendedprice * 100)::bigint % 100)::varchar, 2, '0') || repeat('0', (l_linenumber % 4)::int) || case when l_orderkey % 11 = 0 then '0000001' else '' end as price,
  case when l_orderkey % 13 = 0 then '-' else '' end || (l_partkey % 1000) || '.' || lpad((l_suppkey * 37 % 100000)::varchar, 5, '0') as volume from lineitem),
parts as (select *, regexp_replace(split_part(price, '.', 2), '0+$', '') as price_tail, regexp_replace(split_part(volume, '.', 2), '0+$', '') as volume_tail from texts)"""


def texts(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    price = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"),
                     F.expr("repeat('0', cast(l_linenumber % 4 as int))"), F.when(F.pmod("l_orderkey", F.lit(11)) == 0, "0000001").otherwise(""))
    volume = F.concat(F.when(F.pmod("l_orderkey", F.lit(13)) == 0, "-").otherwise(""), F.pmod("l_partkey", F.lit(1000)).cast("string"), F.lit("."),
                      F.lpad(F.pmod(F.col("l_suppkey") * 37, F.lit(100_000)).cast("string"), 5, "0"))
    return lines.select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), price.alias("price"), volume.alias("volume"))


def _sql(select: str) -> str:
    return f"with {TEXTS} {select}"


@query("B1_price_units", _sql("""select l_orderkey, line, price, case when length(price_tail) <= 8 then (split_part(price, '.', 1) || rpad(left(price_tail, 8), 8, '0'))::bigint end as units from parts"""))
def price_units(spark, sf_dir):
    return texts(spark, sf_dir).select("l_orderkey", "line", "price", exact.price_units(F.col("price")).alias("units"))


@query("B2_fits_decimal", _sql("""select l_orderkey, line, length(price_tail) <= 4 as price_fits, left(volume, 1) <> '-' and length(volume_tail) <= 4 as volume_fits, length(volume_tail) <= 4 as signed_fits from parts"""))
def fits(spark, sf_dir):
    return texts(spark, sf_dir).select("l_orderkey", "line", exact.fits_decimal(F.col("price"), 4).alias("price_fits"), exact.fits_decimal(F.col("volume"), 4).alias("volume_fits"),
                                       exact.fits_decimal(F.col("volume"), 4, signed=True).alias("signed_fits"))


@query("B12_decimal_places", _sql("select l_orderkey, line, length(price_tail) as price_places, length(volume_tail) as volume_places from parts"))
def places(spark, sf_dir):
    return texts(spark, sf_dir).select("l_orderkey", "line", exact.decimal_places(F.col("price")).cast("long").alias("price_places"), exact.decimal_places(F.col("volume")).cast("long").alias("volume_places"))


@query("B13_decimal_text", _sql(r"select l_orderkey, line, regexp_replace(price, '\.?0+$', '') as price_text from parts"))
def decimal_text(spark, sf_dir):
    return texts(spark, sf_dir).select("l_orderkey", "line", exact.decimal_text(F.col("price")).alias("price_text"))


@query("B9_representation_admission", _sql("""select l_orderkey % 10 as series, count(*) as source, count(*) filter (length(volume_tail) <= 4 and left(volume, 1) <> '-') as admitted,
  count(*) filter (length(volume_tail) > 4 and left(volume, 1) <> '-') as volume_exceeds_canonical_scale, count(*) filter (left(volume, 1) = '-') as negative_volume from parts group by 1"""))
def admission(spark, sf_dir):
    marked = ops.representation_admission(texts(spark, sf_dir))
    return marked.groupBy(F.pmod("l_orderkey", F.lit(10)).alias("series")).agg(
        F.count("*").alias("source"), F.count(F.when(F.col("reason").isNull(), 1)).alias("admitted"), *[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in ("volume_exceeds_canonical_scale", "negative_volume")])


@query("B3_stable_bucket", with_views("ticks", sql="select k, k % 8 as bucket, count(*) as n from ticks group by 1, 2"))
def bucket(spark, sf_dir):
    return views.ticks(spark, sf_dir).groupBy("k", exact.stable_bucket(F.col("k")).alias("bucket")).agg(F.count("*").alias("n"))


@query("B4_partition_columns", with_views("settlement_rows", sql="select extract(year from epoch_ms(t)) as year, extract(month from epoch_ms(t)) as month, k % 8 as bucket, count(*) as n from settlement_rows group by all"))
def partitions(spark, sf_dir):
    from tidemark.sources.canonical import partition_columns

    return partition_columns(views.settlement_rows(spark, sf_dir)).groupBy("year", "month", "bucket").agg(F.count("*").alias("n"))


# candles with some broken by rule, from the line items of an order
CANDLES = """raw_candles as (select l_orderkey as k, l_linenumber::bigint as line, round(l_extendedprice * 100)::bigint as open, round(l_extendedprice * 100)::bigint + l_partkey % 500 as high,
  round(l_extendedprice * 100)::bigint - l_suppkey % 300 - case when l_partkey % 29 = 0 then 99999999999 else 0 end as low,
  round(l_extendedprice * 100)::bigint + (l_partkey * 7 + l_suppkey) % 900 - 350 as close, l_quantity::bigint - case when l_orderkey % 97 = 0 then 60 else 0 end as volume,
  round(l_extendedprice * 100)::bigint - case when l_orderkey % 89 = 0 then 99999999999 else 0 end as turnover, case when l_orderkey % 83 = 0 then ' ' when l_orderkey % 79 = 0 then null else l_returnflag end as source_id,
  (epoch_us(l_shipdate) // 1000) + case when l_orderkey % 31 = 0 then 1 else 0 end as t, l_orderkey, l_partkey, l_suppkey, l_linestatus from lineitem),
candles as (select * replace (case when l_partkey % 41 = 0 then null else open end as open, case when l_suppkey % 37 = 0 then null else close end as close,
    case when l_orderkey % 61 = 0 then null else volume end as volume, case when l_orderkey % 53 = 0 then -60000 when l_orderkey % 71 = 0 then null else t end as t),
  case when l_orderkey % 43 = 0 then '' else 'linear' end as category, case when l_orderkey % 47 = 0 then null else l_linestatus end as ingestion_id,
  line - case when l_orderkey % 59 = 0 then 8 else 0 end as quality_flags from raw_candles)"""


def candles(spark, sf_dir):
    open_ = F.round(F.col("l_extendedprice") * 100).cast("long")
    low = open_ - F.pmod("l_suppkey", F.lit(300)) - F.when(F.pmod("l_partkey", F.lit(29)) == 0, F.lit(99_999_999_999)).otherwise(F.lit(0))
    raw = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linestatus", F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("line"), open_.alias("open"), (open_ + F.pmod("l_partkey", F.lit(500))).alias("high"), low.alias("low"),
        (open_ + F.pmod(F.col("l_partkey") * 7 + F.col("l_suppkey"), F.lit(900)) - 350).alias("close"),
        (F.col("l_quantity").cast("long") - F.when(F.pmod("l_orderkey", F.lit(97)) == 0, 60).otherwise(0)).alias("volume"),
        (open_ - F.when(F.pmod("l_orderkey", F.lit(89)) == 0, F.lit(99_999_999_999)).otherwise(F.lit(0))).alias("turnover"),
        F.when(F.pmod("l_orderkey", F.lit(83)) == 0, " ").when(F.pmod("l_orderkey", F.lit(79)) == 0, F.lit(None)).otherwise(F.col("l_returnflag")).alias("source_id"),
        (times.epoch_ms(F.col("l_shipdate")) + F.when(F.pmod("l_orderkey", F.lit(31)) == 0, 1).otherwise(0)).alias("t"))
    each = lambda column, n: F.pmod(column, F.lit(n)) == 0
    return raw.withColumns({
        "open": F.when(~each("l_partkey", 41), F.col("open")), "close": F.when(~each("l_suppkey", 37), F.col("close")), "volume": F.when(~each("l_orderkey", 61), F.col("volume")),
        "t": F.when(each("l_orderkey", 53), -60_000).when(~each("l_orderkey", 71), F.col("t")), "category": F.when(each("l_orderkey", 43), "").otherwise("linear"),
        "ingestion_id": F.when(~each("l_orderkey", 47), F.col("l_linestatus")), "quality_flags": F.col("line") - F.when(each("l_orderkey", 59), 8).otherwise(0)})


@query("B5_candle_violations", f"""with {CANDLES} select k, line, concat_ws(',', case when open is null or high is null or low is null or close is null then 'null_price' end,
  case when volume is null or turnover is null then 'null_volume' end, case when k <= 0 then 'instrument_id' end, case when t is null or t % 60000 <> 0 then 'not_minute_aligned' end,
  case when t < 0 then 'negative_time' end,
  case when least(open, high, low, close) <= 0 then 'non_positive_price' end, case when low > high then 'low_exceeds_high' end, case when open < low or open > high then 'open_outside_low_high' end,
  case when close < low or close > high then 'close_outside_low_high' end, case when volume < 0 then 'negative_volume' end,
  case when turnover < 0 then 'negative_turnover' end, case when coalesce(trim(source_id), '') = '' then 'empty_source_id' end,
  case when category = '' then 'empty_category' end, case when ingestion_id is null then 'empty_ingestion_id' end, case when quality_flags < 0 then 'negative_quality_flags' end) as codes from candles""")
def candle_violations(spark, sf_dir):
    return candles(spark, sf_dir).select("k", "line", F.array_join(ops.candle_violations(), ",").alias("codes"))


@query("B8_quarantine_candles", f"""with {CANDLES}, judged as (select *, case when open is null or high is null or low is null or close is null or volume is null or least(open, high, low, close) <= 0 or volume < 0 then 'rejected' when low > high then 'low_exceeds_high' when open < low or open > high then 'open_outside_low_high'
  when close < low or close > high then 'close_outside_low_high' end as reason from candles)
  select coalesce(reason, 'admitted') as reason, count(*) as n, min(k) as first_k from judged group by 1""")
def quarantine(spark, sf_dir):
    marked = ops.quarantine(candles(spark, sf_dir))
    return marked.groupBy(F.coalesce("reason", F.lit("admitted")).alias("reason")).agg(F.count("*").alias("n"), F.min("k").alias("first_k"))


@query("B6_funding_violations", with_views("settlement_rows", sql="""select id, concat_ws(',', case when k % 500 = 0 then 'instrument_id' end, case when (t + id % 7) % 60000 <> 0 then 'not_minute_aligned' end,
  case when id % 400 - 3 <= 0 then 'non_positive_interval' end) as codes from settlement_rows"""))
def funding_violations(spark, sf_dir):
    rows = views.settlement_rows(spark, sf_dir).select("id", F.when(F.pmod("k", F.lit(500)) == 0, 0).otherwise(F.col("k")).alias("k"), (F.col("t") + F.pmod("id", F.lit(7))).alias("t"), (F.pmod("id", F.lit(400)) - 3).alias("interval"))
    return rows.select("id", F.array_join(ops.funding_violations(), ",").alias("codes"))


@query("B7_instrument_violations", with_views("instruments", sql="""select k, concat_ws(',', case when price % 10 - 1 <= 0 then 'non_positive_tick' end, case when k % 17 = 0 then 'non_positive_step' end,
  case when size - 2 <= 0 then 'non_positive_min_quantity' end, case when k % 23 = 0 then 'non_positive_min_leverage' end, case when k % 19 - 1 <= 0 then 'non_positive_max_leverage' end,
  case when k % 23 > k % 19 - 1 then 'leverage_bounds' end, case when size - 2 > 40 then 'quantity_bounds' end,
  case when k % 50 = 0 then 'delivery_before_launch' end) as codes from instruments"""))
def instrument_violations(spark, sf_dir):
    rows = views.instruments(spark, sf_dir).select(
        "k", (F.pmod("price", F.lit(10)) - 1).alias("tick"), (F.col("size") - 2).alias("min_quantity"), F.lit(40).alias("max_quantity"),
        F.pmod("k", F.lit(17)).alias("step"), F.pmod("k", F.lit(23)).alias("min_leverage"), (F.pmod("k", F.lit(19)) - 1).alias("max_leverage"), F.lit(1_000).alias("launch"),
        F.when(F.pmod("k", F.lit(50)) == 0, 999).otherwise(F.lit(None)).alias("delivery"))
    return rows.select("k", F.array_join(ops.instrument_violations(), ",").alias("codes"))


@query("B10_eligible_instruments", with_views("instruments", sql="select k, symbol from instruments where kind = 'ECONOMY' and brand in ('Brand#1', 'Brand#2', 'Brand#3')"))
def eligible(spark, sf_dir):
    return views.instruments(spark, sf_dir).filter((F.col("kind") == "ECONOMY") & F.col("brand").isin("Brand#1", "Brand#2", "Brand#3")).select("k", "symbol")


@query("B11_tick_round", with_views("ticks", sql="select event_id, price - price % 25 as down, case when price % 25 = 0 then price else price - price % 25 + 25 end as up from ticks"))
def tick_round(spark, sf_dir):
    return views.ticks(spark, sf_dir).select("event_id", exact.tick_round(F.col("price"), F.lit(25)).alias("down"), exact.tick_round(F.col("price"), F.lit(25), up=True).alias("up"))


@query("B14_row_digest", with_views("ticks", sql="""select event_id, sha256('{"event_id":"' || event_id || '","k":"' || k || '","kind":"' || kind || '","price":"' || price || '"}') as digest from ticks"""))
def row_digest(spark, sf_dir):
    return views.ticks(spark, sf_dir).select("event_id", exact.row_digest("k", "price", "kind", "event_id").alias("digest"))


@query("B15_minute_align", with_views("ticks", sql="select event_id, t // 60000 * 60000 as at_or_before, (t + 59999) // 60000 * 60000 as at_or_after, t // 60000 * 60000 + 60000 as after from ticks"))
def minute_align(spark, sf_dir):
    t = F.col("t")
    return views.ticks(spark, sf_dir).select("event_id", times.floor_minute(t).alias("at_or_before"), times.ceil_minute(t).alias("at_or_after"), times.after_minute(t).alias("after"))


NOW = 1_705_276_830_000


@query("B16_closed_only", with_views("bars", sql=f"select k, t from bars where t < {NOW} // 60000 * 60000"))
def closed_only(spark, sf_dir):
    return views.minute_bars(spark, sf_dir).filter(times.is_closed(F.col("t"), NOW)).select("k", "t")


@query("B17_units_to_decimal", with_views("ticks", sql="select event_id, (price::decimal(18,2) / 100)::decimal(38,2)::varchar as price from (select event_id, price from ticks)").replace("(price::decimal(18,2) / 100)::decimal(38,2)::varchar", "(price // 100) || '.' || lpad((price % 100)::varchar, 2, '0')"))
def to_decimal(spark, sf_dir):
    return views.ticks(spark, sf_dir).select("event_id", exact.units_to_decimal(F.col("price"), 2).cast("string").alias("price"))


@query("B20_spreads", with_views("instruments", "tickers", sql="""select i.symbol, (t.high - t.low) * 10000 // i.price as range_bps, (t.high - t.low) * 20000 // (t.high + t.low) as spread_bps, greatest(i.size * i.price, 50000) as minimum_order from instruments i join tickers t on i.symbol = t.symbol"""))
def spreads(spark, sf_dir):
    met = views.instruments(spark, sf_dir).join(views.tickers(spark, sf_dir), "symbol")
    return met.select("symbol", F.floor((F.col("high") - F.col("low")) * 10_000 / F.col("price")).alias("range_bps"),
                      F.floor((F.col("high") - F.col("low")) * 20_000 / (F.col("high") + F.col("low"))).alias("spread_bps"), F.greatest(F.col("size") * F.col("price"), F.lit(50_000)).alias("minimum_order"))
