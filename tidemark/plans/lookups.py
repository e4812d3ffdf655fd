"""Queries of as-of lookups, lifecycle checks and matching joins."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidemark.functions import exact
from tidemark.functions.times import DAY
from tidemark.operators import lookups as ops
from tidemark.operators.presence import presence
from tidemark.plans.catalog import stored_bars
from tidemark.plans.registry import query
from tidemark.plans.sql import with_views
from tidemark.sources import canonical, views


@query("C1_join_dimension", with_views("instruments", "tickers", sql="select i.k, i.symbol, i.price, t.turnover, t.n from instruments i join tickers t on i.symbol = t.symbol"))
def join_dimension(spark, sf_dir):
    return ops.join_dimension(views.instruments(spark, sf_dir), views.tickers(spark, sf_dir)).select("k", "symbol", "price", "turnover", "n")


@query("C2_as_of_snapshot", with_views("snapshots", "probes", sql="""with valid as (select *, lead(t) over (partition by k order by t) as until from snapshots)
  select p.k, p.t, p.l_orderkey, p.line, p.l_partkey, v.t as snapshot_t, v.status, v.symbol, v.t is not null as found
  from probes p left join valid v on p.k = v.k and v.t <= p.t and (v.until is null or p.t < v.until)"""))
def as_of(spark, sf_dir):
    return ops.as_of_snapshot(views.probes(spark, sf_dir), views.snapshots(spark, sf_dir), ["status", "symbol"])


# inventories of thirty days each, every fourth one partial; some probes come before the first
PERIOD = 2_592_000_000
INVENTORIES = f"""inv as (select distinct t // {PERIOD} * {PERIOD} as t, case when t // {PERIOD} % 4 = 0 then 'partial' else 'complete' end as inventory_status from snapshots),
recs as (select t // {PERIOD} * {PERIOD} as snapshot_t, k, arg_max(status, t) as status from snapshots group by 1, 2),
asked as (select k, t - case when k % 5 = 0 then 129600000000 else 0 end as t, l_orderkey, line from probes)"""


def _inventories(spark, sf_dir):
    start = F.floor(F.col("t") / PERIOD) * PERIOD
    rows = views.snapshots(spark, sf_dir).withColumn("snapshot_t", start)
    status = F.when(F.floor(F.col("snapshot_t") / PERIOD) % 4 == 0, "partial").otherwise("complete")
    return rows.select(F.col("snapshot_t").alias("t"), status.alias("inventory_status")).distinct(), rows.groupBy("snapshot_t", "k").agg(F.max_by("status", "t").alias("status"))


@query("C2_select_as_of", with_views("snapshots", "probes", sql=f"""with {INVENTORIES}, valid as (select *, lead(t) over (order by t) as until from inv)
  select a.k, a.t, a.l_orderkey, a.line, v.t as snapshot_t,
    case when v.t is null then 'before_first_snapshot' when v.inventory_status <> 'complete' then 'partial_inventory' when r.k is null then 'absent_instrument' end as problem
  from asked a left join valid v on v.t <= a.t and (v.until is null or a.t < v.until) left join recs r on r.snapshot_t = v.t and r.k = a.k"""))
def select_as_of(spark, sf_dir):
    asked = views.probes(spark, sf_dir).select("k", (F.col("t") - F.when(F.pmod("k", F.lit(5)) == 0, DAY * 1500).otherwise(0)).alias("t"), "l_orderkey", "line")
    return ops.select_as_of(asked, *_inventories(spark, sf_dir), require_complete=True)


@query("D8_timeline_summary", with_views("snapshots", "probes", sql=f"""with {INVENTORIES}, s as (select count(*) as snapshots, count(*) filter (inventory_status = 'partial') as partial, min(t) as first_t,
    max(t) as last_t, arg_max(inventory_status, t) as last_status from inv),
  c as (select status, count(*) as n from recs where snapshot_t = (select last_t from s) group by status)
  select s.*, (select sum(n)::bigint from c) as records, (select string_agg(status || ':' || n, ',' order by status) from c) as status_counts from s"""))
def timeline_summary(spark, sf_dir):
    return ops.timeline_summary(*_inventories(spark, sf_dir))


@query("D8_status_counts", with_views("snapshots", sql="""select status, count(*) as snapshots, count(distinct k) as instruments, min(t) as first_t, max(t) as last_t from snapshots group by status"""))
def status_counts(spark, sf_dir):
    return views.snapshots(spark, sf_dir).groupBy("status").agg(
        F.count("*").alias("snapshots"), F.countDistinct("k").alias("instruments"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


LIFE = """observed as (select k, t, status, symbol || (k // 40) as symbol, case when id % 50 = 0 then 1 else 0 end + 789000000000 as launch,
    case when status = 'F' and id % 3 > 0 then 996000000000 + (case when id % 40 = 0 then 86400000 else 0 end) end as delivery from snapshots),
reused as (select symbol from observed group by symbol having count(distinct k) > 1),
per as (select o.k, count(distinct launch) as launches, count(distinct delivery) as deliveries, min(launch) as l, min(delivery) as d, bool_or(status = 'F') as closed, bool_or(r.symbol is not null) as reused, count(*) as n
  from observed o left join reused r on o.symbol = r.symbol group by o.k)"""


@query("D9_lifecycle_conflicts", with_views("snapshots", sql=f"""with {LIFE}
  select k, n, concat_ws(',', case when closed and deliveries <> 1 then 'closed_without_delivery_time' end, case when deliveries > 1 then 'conflicting_delivery_time' end,
    case when launches <> 1 then 'conflicting_launch_time' end, case when launches = 1 and deliveries = 1 and d <= l then 'non_positive_lifecycle_interval' end,
    case when reused then 'symbol_reused_across_instrument_ids' end) as blockers from per"""))
def lifecycle_conflicts(spark, sf_dir):
    rows = views.snapshots(spark, sf_dir)
    launch = F.when(F.pmod("id", F.lit(50)) == 0, 1).otherwise(0) + F.lit(789_000_000_000)
    delivery = F.when((F.col("status") == "F") & (F.pmod("id", F.lit(3)) > 0), F.lit(996_000_000_000) + F.when(F.pmod("id", F.lit(40)) == 0, DAY).otherwise(0))
    observed = rows.select("k", "t", F.col("status") == "F", F.concat("symbol", F.floor(F.col("k") / 40).cast("string")).alias("symbol"), launch.alias("launch"), delivery.alias("delivery")).toDF(
        "k", "t", "closed", "symbol", "launch", "delivery")
    found = ops.lifecycle_conflicts(observed)
    return found.select("k", "n", F.array_join("blockers", ",").alias("blockers"))


@query("C5_match_announcements", with_views("instruments", sql="""with words as (select distinct k, unnest(string_split(upper(name), ' ')) as token from instruments),
  told as (select doc_id, upper(text) as text from documents where text is not null), tokens as (select distinct doc_id, unnest(regexp_extract_all(text, '[A-Z0-9]+')) as token from told),
  matched as (select w.k, t.doc_id from words w join tokens t using (token) group by all),
  per as (select i.k, count(m.doc_id) as matches from instruments i left join matched m on i.k = m.k group by i.k)
  select k, matches, case when matches = 0 then 'unmatched' when matches = 1 then 'unique' else 'ambiguous' end as class from per"""))
def match_announcements(spark, sf_dir):
    inst = views.instruments(spark, sf_dir).select("k", F.split(F.upper("name"), " ").alias("names"))
    docs = views.table(spark, sf_dir, "documents").select("doc_id", F.upper("text").alias("text"))
    return ops.match_announcements(inst, docs)


# whole texts with a pair behind them: five ways to part it, one of them no pair, and four words, one of them no derivative's
LISTINGS = (("", "/", "-", " ", ":"), ("perpetual", "derivatives", "contract", "spot"))


@query("C5_match_listings", with_views("instruments", sql=r"""with told as (select doc_id, upper(coalesce(text, '') || ' P' || doc_id % 977 || ['', '/', '-', ' ', ':'][doc_id % 5 + 1] || 'usdt ' ||
    ['perpetual', 'derivatives', 'contract', 'spot'][doc_id // 5 % 4 + 1]) as text from documents),
  told_of as (select * from told where contains(text, 'PERPETUAL') or contains(text, 'DERIVATIVE') or regexp_matches(text, '(^|[^A-Z])CONTRACTS?([^A-Z]|$)')),
  named as (select doc_id, unnest(regexp_extract_all(text, '(?:^|[^A-Z0-9])(P[0-9]+)[\s/_-]*USDT(?:[^A-Z0-9]|$)', 1)) as base from told_of),
  dated as (select k, 'P' || (k - 1) as base, size * 86400000 as event_t from instruments where size % 7 > 0),
  per as (select d.k, d.event_t, count(distinct n.doc_id) filter (d.event_t >= 864000000) as matches from dated d left join named n on n.base = d.base group by 1, 2)
  select k, matches, case when event_t < 864000000 then 'outside_archive' when matches = 0 then 'unmatched' when matches = 1 then 'unique' else 'ambiguous' end as class from per""".replace("\\\\s", "\\s")))
def match_listings(spark, sf_dir):
    day = F.when(F.pmod("size", F.lit(7)) > 0, F.col("size") * DAY)
    inst = views.instruments(spark, sf_dir).select("k", "symbol", F.regexp_replace("symbol", "USDT$", "").alias("base"), day.alias("event_t"))
    parted, words = (F.array(*map(F.lit, x)) for x in LISTINGS)
    pair = F.concat(F.lit(" P"), F.pmod("doc_id", F.lit(977)).cast("string"), F.get(parted, F.pmod("doc_id", F.lit(5)).cast("int")), F.lit("usdt "), F.get(words, F.pmod(F.floor(F.col("doc_id") / 5), F.lit(4)).cast("int")))
    texts = views.table(spark, sf_dir, "documents").select("doc_id", F.upper(F.concat(F.coalesce("text", F.lit("")), pair)).alias("text"))
    return ops.match_listings(inst, texts, 10 * DAY)


@query("C5_pair_text", with_views("instruments", sql=r"""select k, regexp_matches(upper(name || ' ' || kind), '(^|[^A-Z0-9])(RED|BLUE)[ /_-]?(WIDGET|BOLT|GEAR)([^A-Z0-9]|$)') as named from instruments"""))
def pair_text(spark, sf_dir):
    text = F.upper(F.concat_ws(" ", "name", "kind"))
    return views.instruments(spark, sf_dir).select("k", F.regexp_like(text, F.lit(r"(^|[^A-Z0-9])(RED|BLUE)[ /_-]?(WIDGET|BOLT|GEAR)([^A-Z0-9]|$)")).alias("named"))


@query("C6_event_date_relation", with_views("snapshots", sql="""with ev as (select k, min(t) // 86400000 as d from snapshots group by k), reg as (select c_custkey + 1 as k, 9131 + c_custkey % 2000 as d from customer),
  j as (select e.d - r.d as delta from ev e join reg r on e.k = r.k)
  select count(*) filter (delta < 0) as before, count(*) filter (delta = 0) as same, count(*) filter (delta > 0) as after, max(abs(delta))::bigint as max_abs_days from j"""))
def date_relation(spark, sf_dir):
    events = views.snapshots(spark, sf_dir).groupBy("k").agg(F.floor(F.min("t") / DAY).alias("d"))
    registry = views.table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("k"), (9131 + F.pmod("c_custkey", F.lit(2000))).alias("r"))
    return ops.date_relation(events.join(registry, "k").withColumn("delta", F.col("d") - F.col("r")))


@query("C7_listing_vs_first_trade", with_views("ticks", sql="""with firsts as (select k, kind, min(t) as first_t from ticks group by all), ev as (select k, min(t) + 86400000 * (k % 3) as event_t from ticks group by k)
  select f.k, f.kind, f.first_t, e.event_t, f.first_t // 86400000 = e.event_t // 86400000 as same_day, date_trunc('month', epoch_ms(f.first_t)) = date_trunc('month', epoch_ms(e.event_t)) as same_month,
    f.first_t < e.event_t as before_event from firsts f join ev e on f.k = e.k"""))
def listing(spark, sf_dir):
    ticks = views.ticks(spark, sf_dir)
    events = ticks.groupBy("k").agg(F.min("t").alias("m")).select("k", (F.col("m") + DAY * F.pmod("k", F.lit(3))).alias("event_t"))
    return ops.listing_vs_first(ticks.select("k", "kind", "t"), events)


@query("C8_universe_compare", """with here as (select distinct p_brand || p_size as symbol, nullif(p_type, 'ECONOMY') as status from part where p_size <= 30), there as (select p_brand || p_size as symbol from part where p_size > 20 group by 1)
  select coalesce(h.symbol, t.symbol) as symbol, h.status, case when h.symbol is null then 'archive_only' when t.symbol is null then 'current_only' else 'both' end as side
  from here h full join there t on h.symbol = t.symbol""")
def universe_compare(spark, sf_dir):
    part = views.table(spark, sf_dir, "part")
    symbol = F.concat("p_brand", F.col("p_size").cast("string")).alias("symbol")
    here = part.filter("p_size <= 30").select(symbol, F.nullif("p_type", F.lit("ECONOMY")).alias("status")).distinct()
    there = part.filter("p_size > 20").select(symbol)
    return ops.universe_compare(here, there)


# what is published lacks some bars of kind 3, what is covered all of kind 2; the catalog has the rows of the stored files
@query("C10_reconcile_stages", with_views("ticks", "bars", sql="""with a as (select k % 4 as kind, count(distinct (k, t // 60000)) as n from ticks group by 1),
  p as (select k % 4 as kind, count(*) as n from bars where k % 4 <> 3 or close % 10 <> 0 group by 1), v as (select k % 4 as kind, count(distinct (k, t)) as n from bars where k % 4 <> 2 group by 1),
  c as (select k % 4 as kind, count(*) as n from bars group by 1)
  select a.kind, a.n as acquisition, p.n as publication, v.n as coverage, c.n as catalog, coalesce(a.n = p.n and a.n = v.n and a.n = c.n, false) as agree
  from a left join p on a.kind = p.kind left join v on a.kind = v.kind left join c on a.kind = c.kind"""))
def reconcile(spark, sf_dir):
    ticks, bars = views.ticks(spark, sf_dir), views.minute_bars(spark, sf_dir)
    kind = F.pmod("k", F.lit(4)).alias("kind")
    acquired = ticks.select(kind, "k", F.floor(F.col("t") / 60_000).alias("m")).distinct().groupBy("kind").agg(F.count("*").alias("n"))
    published = bars.filter((F.pmod("k", F.lit(4)) != 3) | (F.pmod("close", F.lit(10)) != 0)).groupBy(kind).agg(F.count("*").alias("n"))
    covered = presence(seen=bars.filter(F.pmod("k", F.lit(4)) != 2)).groupBy(kind).agg(F.sum(F.bit_count("seen")).alias("n"))
    files = canonical.partition_manifest(stored_bars(spark, sf_dir))
    catalog = files.select(F.pmod("bucket", F.lit(4)).alias("kind"), F.col("rows").alias("n"))
    return ops.reconcile_stages(acquisition=acquired, publication=published, coverage=covered, catalog=catalog)


@query("C11_trade_mark_join", with_views("ticks", "bars", sql="""with marks as (select k, t // 60000 * 60000 as t, max(price) as mark from ticks where kind = 'click' group by all)
  select b.k, b.t, b.close, m.mark from bars b join marks m on b.k = m.k and b.t = m.t"""))
def trade_mark(spark, sf_dir):
    ticks = views.ticks(spark, sf_dir)
    marks = ticks.filter("kind = 'click'").groupBy("k", (F.col("t") - F.pmod("t", F.lit(60_000))).alias("t")).agg(F.max("price").alias("mark"))
    return views.bars(ticks).join(marks, ["k", "t"]).select("k", "t", "close", "mark")


@query("D19_archive_bounds", with_views("ticks", sql="""with line as (select kind, t, k, lag(t) over (partition by kind order by k, event_id) as prev from ticks)
  select kind, min(t) as oldest, max(t) as newest, count(*) as n, count(*) filter (t > prev) as inversions from line group by kind"""))
def archive_bounds(spark, sf_dir):
    return ops.archive_bounds(_archive(spark, sf_dir))


def _archive(spark, sf_dir):
    return views.ticks(spark, sf_dir).select("kind", F.col("k").alias("page"), F.col("event_id").alias("place"), "t")


# purchases list instruments, signups are ordered by a page of their own each; every ninth instrument has no launch
@query("D19_archive_depth", with_views("ticks", sql="""with items as (select kind, case when kind = 'signup' then -t else k end as page, event_id, t from ticks),
  line as (select kind, t, lag(t) over (partition by kind order by page, event_id) as prev from items),
  bounds as (select kind, min(t) as oldest, count(*) filter (t > prev) as inversions from line group by kind),
  edge as (select max(oldest) filter (kind = 'purchase') as listing_start, min(oldest) as archive_start, 2 - count(*) filter (kind in ('purchase', 'signup') and inversions = 0) as unordered from bounds),
  life as (select k, case when k % 9 > 0 then min(t) end as launch from ticks group by k),
  met as (select count(*) as instruments, min(launch) as first_launch, max(launch) as last_launch, count(*) filter (launch < listing_start) as before, count(*) filter (launch is null) as unknown from life, edge)
  select *, case when before + unknown + unordered = 0 then 'compatible' else 'blocked' end as status from edge, met"""))
def archive_depth(spark, sf_dir):
    items = _archive(spark, sf_dir).withColumn("page", F.when(F.col("kind") == "signup", -F.col("t")).otherwise(F.col("page")))
    launches = views.ticks(spark, sf_dir).groupBy("k").agg(F.min("t").alias("launch")).withColumn("launch", F.when(F.pmod("k", F.lit(9)) > 0, F.col("launch")))
    return ops.archive_depth(ops.archive_bounds(items), launches, "purchase", ("purchase", "signup"))


# with rows that differ only in where their columns part: ("7|", "b") and ("7", "|b")
PROFILED = """items as (select text, source from documents union all select (doc_id // 10) || '|', 'b' from documents where doc_id % 10 <> 2 and doc_id % 5 = 2
  union all select (doc_id // 10)::varchar, '|b' from documents where doc_id % 10 = 2)"""


@query("D20_completeness_profile", f"""with {PROFILED}
  select count(*) as n, count(*) filter (text is null or trim(text) = '') as blank_text, count(*) filter (source is null or trim(source) = '') as blank_source,
    (select coalesce(sum(c - 1), 0)::bigint from (select count(*) as c from items group by text, source) where c > 1) as repeated_items from items""")
def completeness(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = docs.select("text", "source")
    for before, after, rest in (("", "|", "<> 2"), ("|", "", "= 2")):
        parted = docs.filter(f"doc_id % 10 {rest} and doc_id % 5 = 2")
        rows = rows.unionByName(parted.select(F.concat(F.floor(F.col("doc_id") / 10).cast("string"), F.lit(after)).alias("text"), F.concat(F.lit(before), F.lit("b")).alias("source")))
    return ops.completeness_profile(rows, ["text", "source"])


@query("D20_page_profile", """select count(*) as n, count(*) filter (url is null or trim(url) = '') as blank_url, count(*) filter (html is null or trim(html) = '') as blank_html,
    (select coalesce(sum(c - 1), 0)::bigint from (select count(*) as c from pages group by url, html)) as repeated_items,
    (select coalesce(sum(c - 1), 0)::bigint from (select count(*) as c from pages where trim(url) <> '' group by url)) as repeated_urls from pages""")
def page_profile(spark, sf_dir):
    return ops.completeness_profile(views.table(spark, sf_dir, "pages").select("url", "html"), ["url", "html"], "url")


@query("E20_adjacent_inversions", with_views("ticks", sql="with l as (select k, t, lag(t) over (partition by k order by event_id desc) as prev from ticks) select k, count(*) filter (t > prev) as inversions from l group by k"))
def inversions(spark, sf_dir):
    return ops.adjacent_inversions(views.ticks(spark, sf_dir), Window.partitionBy("k").orderBy(F.col("event_id").desc()))


@query("B18_symbol_token", "select p_partkey, regexp_replace(upper(p_name || '-' || p_brand), '[^A-Z0-9]', '', 'g') as token from part")
def symbol_token(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select("p_partkey", exact.symbol_token(F.concat_ws("-", "p_name", "p_brand")).alias("token"))


@query("B19_announcement_text", "select p_partkey, upper(concat_ws(' ', p_name, p_type, p_brand)) as text from part")
def announcement_text(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select("p_partkey", exact.joined_text(F.col("p_name"), F.array("p_type", "p_brand")).alias("text"))
