"""Queries of landed pages, inventories, listings and range planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.coverage import requests
from tidemark.plans.registry import query
from tidemark.plans.sql import with_views
from tidemark.sources import pages, ranges, views


def _text(units):
    """Cents as decimal text."""
    size = F.abs(units)
    return F.concat(F.when(units < 0, "-").otherwise(""), F.floor(size / 100).cast("string"), F.lit("."), F.lpad(F.pmod(size, F.lit(100)).cast("string"), 2, "0"))


def kline_pages(spark, sf_dir):
    """JSON pages of an instrument's day of bars, newest first."""
    bars = views.minute_bars(spark, sf_dir)
    row = F.array(F.col("t").cast("string"), *[_text(F.col(c)) for c in ("open", "high", "low", "close")], F.col("volume").cast("string"), _text(F.col("turnover")))
    days = bars.select("k", F.floor(F.col("t") / 86_400_000).alias("d"), F.struct("t", row.alias("r")).alias("x")).groupBy("k", "d").agg(F.sort_array(F.collect_list("x"), asc=False).alias("xs"))
    page = F.struct("k", F.lit("trade").alias("kind"), F.transform("xs", lambda x: x["r"]).alias("rows"))
    return days.select(F.to_json(page).alias("json"))


@query("A3_read_kline_pages", with_views("bars", sql="""select k, 'trade' as kind, t, open * 1000000 as open, high * 1000000 as high, low * 1000000 as low, close * 1000000 as close, volume::varchar as volume,
  (row_number() over (partition by k, t // 86400000 order by t desc) - 1)::int as place from bars"""))
def read_kline_pages(spark, sf_dir):
    return pages.kline_rows(kline_pages(spark, sf_dir))


@query("A4_read_funding_pages", with_views("settlements", sql="select k, 'S' || k as symbol, t, '0.000' || lpad(rate::varchar, 9, '0') || '000000' as rate from settlements"))
def read_funding_pages(spark, sf_dir):
    rows = views.settlements(spark, sf_dir)
    item = F.struct(F.concat(F.lit("S"), F.col("k").cast("string")).alias("symbol"), F.concat(F.lit("0.000"), F.lpad(F.col("rate").cast("string"), 9, "0")).alias("fundingRate"), F.col("t").cast("string").alias("fundingRateTimestamp"))
    landed = rows.groupBy("k").agg(F.collect_list(item).alias("rows")).select(F.to_json(F.struct("k", "rows")).alias("json"))
    return pages.funding_rows(landed).withColumn("rate", F.col("rate").cast("string"))


INVENTORY = """inv as (select case when size > 25 then 'Trading' else 'Closed' end as status, symbol, k as id, 1000 + k as launch, case when size > 25 then 0 else 2000 + k end as delivery,
  case when k % 3 = 0 then 0 else 480 end::bigint as interval, (price % 97) || '.50' as tick, size::varchar as min_quantity from instruments)"""


def inventory_pages(spark, sf_dir):
    inst = views.instruments(spark, sf_dir)
    open_ = F.col("size") > 25
    record = F.struct("symbol", F.col("k").alias("id"), (F.col("k") + 1000).alias("launch"), F.when(open_, 0).otherwise(F.col("k") + 2000).alias("delivery"),
                      F.when(F.pmod("k", F.lit(3)) == 0, 0).otherwise(480).alias("interval"), F.struct(F.concat(F.pmod("price", F.lit(97)).cast("string"), F.lit(".50")).alias("tickSize")).alias("priceFilter"),
                      F.struct(F.col("size").cast("string").alias("minOrderQty")).alias("lotSizeFilter"))
    twice = inst.select(F.when(open_, "Trading").otherwise("Closed").alias("status"), F.pmod("k", F.lit(20)).alias("page"), F.explode(F.array(record, record)).alias("r"))
    return twice.groupBy("status", "page").agg(F.collect_list("r").alias("records")).select(F.to_json(F.struct("status", "records")).alias("json"))


@query("A5_read_inventory", with_views("instruments", sql=f"with {INVENTORY} select * from inv"))
def read_inventory(spark, sf_dir):
    return pages.inventory_rows(inventory_pages(spark, sf_dir))


@query("A6_build_registry", with_views("instruments", sql=f"""with {INVENTORY} select status, symbol, id, launch, nullif(delivery, 0) as delivery, nullif(interval, 0)::bigint as interval,
  split_part(tick, '.', 1)::bigint * 100000000 + 50000000 as tick_units, true as unique_id from inv"""))
def build_registry(spark, sf_dir):
    return pages.build_registry(pages.inventory_rows(inventory_pages(spark, sf_dir))).drop("tick", "min_quantity")


@query("A7_archive_date_coverage", with_views("ticks", sql="""with f as (select distinct 'S' || k as symbol, date '1970-01-01' + (t // 86400000)::int as day from ticks)
  select symbol, min(day) as first_day, max(day) as last_day, count(*) as files, (max(day) - min(day) + 1) - count(*) as missing from f group by symbol"""))
def archive_dates(spark, sf_dir):
    from tidemark.functions.times import utc_date

    link = F.concat(F.lit('<a href="S'), F.col("k").cast("string"), utc_date(F.col("t")).cast("string"), F.lit('.csv.gz">x</a>'))
    listing = views.ticks(spark, sf_dir).select("k", link.alias("a")).groupBy("k").agg(F.array_join(F.collect_set("a"), "\n").alias("html"))
    return pages.archive_dates(listing)


@query("A7_page_links", """select page_id, len(regexp_extract_all(html, 'href="([^"]*)"', 1)) as links, len(list_distinct(regexp_extract_all(html, 'href="([^"]*)"', 1))) as targets from pages""")
def page_links(spark, sf_dir):
    return pages.link_targets(views.table(spark, sf_dir, "pages").select("page_id", "html"))


REQUESTS = "requests as (select k, min(t) - 60000 as start, max(t) + 60000 as stop from bars group by k)"


@query("A13_range_tiling", with_views("bars", sql=f"""with {REQUESTS}, p as (select k, stop, unnest(generate_series(start, stop, 60000000)) as page_start from requests)
  select k, page_start, least(page_start + 59940000, stop) as page_end from p"""))
def tiling(spark, sf_dir):
    return ranges.range_tiling(requests(views.minute_bars(spark, sf_dir)), 1000)


@query("A14_month_windows", with_views("settlements", sql="""with r as (select k, min(t) as start, max(t) as stop from settlements group by k),
  m as (select k, start as a, stop as b, unnest(generate_series(date_trunc('month', epoch_ms(start)), date_trunc('month', epoch_ms(stop)), interval 1 month)) as m from r)
  select k, extract(year from m) as year, extract(month from m) as month, greatest(a, epoch_ms(m)) as start, least(b, epoch_ms(m + interval 1 month) - 60000) as stop from m"""))
def months(spark, sf_dir):
    return ranges.month_windows(views.settlements(spark, sf_dir).groupBy("k").agg(F.min("t").alias("start"), F.max("t").alias("stop")))


# settlements as requests of a year each side of an instrument's life; some are delivered, some launch within a minute
@query("A14_lifecycle_jobs", with_views("settlements", sql="""with life as (select k, min(t) + 31 as launch, case when k % 3 = 0 then max(t) - 86400000 else 0 end as delivery, min(t) - 31536000000 as a, max(t) + 31536000000 as b from settlements group by k),
  m as (select *, unnest(generate_series(date_trunc('month', epoch_ms(a)), date_trunc('month', epoch_ms(b)), interval 1 month)) as m from life where k % 8 > 0),
  w as (select k, launch, delivery, extract(year from m) as year, extract(month from m) as month, greatest(a, epoch_ms(m)) as start, least(b, epoch_ms(m + interval 1 month) - 60000) as stop from m),
  c as (select k, year, month, greatest(start, (launch + 59999) // 60000 * 60000) as start, case when delivery > 0 then least(stop, (delivery + 59999) // 60000 * 60000 - 60000) else stop end as stop from w)
  select year, month, k % 8 as bucket, count(*) as n, sum(stop - start)::bigint as span, string_agg(k || ':' || start, ',' order by k) as series from c where start <= stop group by all"""))
def jobs(spark, sf_dir):
    sums = views.settlements(spark, sf_dir).groupBy("k").agg(F.min("t").alias("first"), F.max("t").alias("last")).filter("k % 8 > 0")
    requests_ = sums.select("k", (F.col("first") - 31_536_000_000).alias("start"), (F.col("last") + 31_536_000_000).alias("stop"))
    life = sums.select("k", (F.col("first") + 31).alias("launch"), F.when(F.pmod("k", F.lit(3)) == 0, F.col("last") - 86_400_000).otherwise(0).alias("delivery"))
    made = ranges.lifecycle_jobs(ranges.month_windows(requests_), life)
    text = F.array_join(F.transform("series", lambda s: F.concat_ws(":", s["k"], s["start"])), ",")
    span = F.aggregate("series", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return made.select("year", "month", "bucket", F.size("series").cast("long").alias("n"), span.alias("span"), text.alias("series"))
