"""Queries of catalogs, partitions, unions and lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import DAY
from tidemark.operators import sets as ops
from tidemark.operators.digests import partition_digests, table_difference_by_partition
from tidemark.operators.ranks import rank_within
from tidemark.plans.registry import query
from tidemark.plans.sql import with_views
from tidemark.sources import canonical, views
from tidemark.sources.shared import checkpoints, shared_folder

BAR_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in ("k", "t", "open", "high", "low", "close", "volume", "turnover")])


def scratch(spark, label):
    """A new folder in the one that the cluster shares."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored_bars(spark, sf_dir):
    path = scratch(spark, "bars")
    canonical.write_canonical(views.minute_bars(spark, sf_dir).select(*BAR_SCHEMA.names), path)
    return canonical.read_canonical(spark, path, BAR_SCHEMA)


@query("A1_read_canonical", with_views("bars", sql="select k, t, open, high, low, close, volume, turnover from bars"))
def read_canonical(spark, sf_dir):
    return stored_bars(spark, sf_dir).select(*BAR_SCHEMA.names)


@query("A2_read_funding", with_views("settlements", sql="select k, t, rate from settlements"))
def read_funding(spark, sf_dir):
    path = scratch(spark, "funding")
    canonical.write_canonical(views.settlements(spark, sf_dir).select("k", "t", "rate"), path)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("k", "t", "rate")])
    return canonical.read_canonical(spark, path, schema).select("k", "t", "rate")


SELECTED = (1_704_585_600_000, 1_705_190_400_000)


@query("A8_scan_selection", with_views("bars", sql=f"select k, t, close from bars where t between {SELECTED[0]} and {SELECTED[1]} and k in (3, 11, 42, 77)"))
def scan_selection(spark, sf_dir):
    return canonical.scan_selection(stored_bars(spark, sf_dir), *SELECTED, ids=[3, 11, 42, 77]).select("k", "t", "close")


@query("A9_write_canonical", with_views("bars", sql="select extract(year from epoch_ms(t)) as year, extract(month from epoch_ms(t)) as month, k % 8 as bucket, count(*) as n, sum(close)::bigint as closes from bars group by all"))
def write_canonical(spark, sf_dir):
    return stored_bars(spark, sf_dir).groupBy("year", "month", "bucket").agg(F.count("*").alias("n"), F.sum("close").alias("closes"))


@query("A10_dataset_manifest", with_views("bars", sql="""select extract(year from epoch_ms(t)) as year, extract(month from epoch_ms(t)) as month, k % 8 as bucket, count(*) as "rows", count(distinct k) as instruments,
  min(k) as first_k, max(k) as last_k, min(t) as first_t, max(t) as last_t from bars group by all"""))
def dataset_manifest(spark, sf_dir):
    return canonical.partition_manifest(stored_bars(spark, sf_dir))


@query("A11_empty_partition", with_views("bars", sql="select count(*) as n, min(k) as first_k, max(t) as last_t from bars where k < 0"))
def empty_partition(spark, sf_dir):
    kept = views.minute_bars(spark, sf_dir).filter("k < 0").select(*BAR_SCHEMA.names)
    return canonical.empty_partition(spark, BAR_SCHEMA).unionByName(kept).agg(F.count("*").alias("n"), F.min("k").alias("first_k"), F.max("t").alias("last_t"))


@query("G1_union_parents", with_views("settlement_rows", sql="""with u as (select k, t, rate, id from settlement_rows where id % 2 = 0 union all select k, t, rate, id from settlement_rows where id % 2 = 1)
  select k, t, rate, id, count(*) over (partition by k, t) as copies from u"""))
def union_parents(spark, sf_dir):
    rows = views.settlement_rows(spark, sf_dir)
    return ops.union_parents([rows.filter(F.pmod("id", F.lit(2)) == r) for r in (0, 1)])


@query("G2_key_overlap", with_views("settlement_rows", sql="select k, t, count(*) as n from settlement_rows group by k, t having count(*) > 1"))
def key_overlap(spark, sf_dir):
    return ops.key_overlap(views.settlement_rows(spark, sf_dir), "k", "t")


@query("G3_duplicate_or_conflict", with_views("ticks", sql="""select k, price % 50 as p, count(*) as n, count(distinct kind) as versions, case when count(distinct kind) = 1 then 'redundant' else 'conflict' end as class from ticks group by 1, 2 having count(*) > 1"""))
def conflicts(spark, sf_dir):
    return ops.duplicate_or_conflict(views.ticks(spark, sf_dir).withColumn("p", F.pmod("price", F.lit(50))), ["k", "p"], ["kind"])


@query("G4_table_equal", with_views("bars", sql="select k, t, close, 'left' as side from bars where close % 10 = 0"))
def table_equal(spark, sf_dir):
    from tidemark.operators.gaps import table_difference

    bars = views.minute_bars(spark, sf_dir).select("k", "t", "close")
    return table_difference(bars, bars.filter(F.pmod("close", F.lit(10)) != 0))


# one bucket has changed rows, another repeated ones; the others are proven equal by their digests
@query("G4_difference_by_partition", with_views("bars", sql="""select k, t, close, 'left' as side from bars where k % 8 = 3 and close % 97 = 0
  union all select k, t, close + 1, 'right' from bars where k % 8 = 3 and close % 97 = 0 union all select k, t, close, 'right' from bars where k % 8 = 5 and close % 101 = 0"""))
def difference_by_partition(spark, sf_dir):
    bars = stored_bars(spark, sf_dir).select("k", "t", "close", *canonical.PARTITIONS)
    odd, twice = (F.col("bucket") == 3) & (F.pmod("close", F.lit(97)) == 0), (F.col("bucket") == 5) & (F.pmod("close", F.lit(101)) == 0)
    other = bars.withColumn("close", F.when(odd, F.col("close") + 1).otherwise(F.col("close"))).unionByName(bars.filter(twice))
    return table_difference_by_partition(bars, other, list(canonical.PARTITIONS)).drop(*canonical.PARTITIONS)


@query("G4_partition_digests", with_views("bars", sql="select k % 8 as bucket, count(*) as n, k % 8 not in (2, 6) as equal from bars group by 1"))
def digests_of_partitions(spark, sf_dir):
    bars = views.minute_bars(spark, sf_dir).withColumn("bucket", F.pmod("k", F.lit(8)))
    swapped = bars.withColumn("open", F.when(F.pmod("bucket", F.lit(4)) == 2, F.col("close") + 1).otherwise(F.col("open")))
    one, two = (partition_digests(df, ["k", "t", "open", "close"], ["bucket"]) for df in (bars, swapped))
    met = one.join(two.select("bucket", F.col("digest").alias("other")), "bucket")
    return met.select("bucket", "n", F.col("digest").eqNullSafe(F.col("other")).alias("equal"))


@query("G5_partition_gap", with_views("bars", sql="""with need as (select d, k from (select distinct t // 86400000 as d from bars) cross join (select distinct k from bars)), have as (select distinct t // 86400000 as d, k from bars)
  select need.d, need.k from need anti join have on need.d = have.d and need.k = have.k"""))
def partition_gap(spark, sf_dir):
    bars = views.minute_bars(spark, sf_dir).select(F.floor(F.col("t") / DAY).alias("d"), "k").distinct()
    need = bars.select("k").distinct().crossJoin(bars.select("d").distinct())  # what is required: each instrument on each day
    return ops.partition_gap(need, bars, "d", "k")


MONTHLY = "monthly as (select distinct kind, (t // 259200000) as month, k from ticks)"


def _monthly(spark, sf_dir):
    return views.ticks(spark, sf_dir).select("kind", F.floor(F.col("t") / (3 * DAY)).alias("month"), "k")


@query("G8_source_overlap", with_views("ticks", sql=f"with {MONTHLY} select a.k, a.month, a.kind as a, b.kind as b from monthly a join monthly b on a.k = b.k and a.month = b.month and a.kind < b.kind"))
def source_overlap(spark, sf_dir):
    return ops.source_overlap(_monthly(spark, sf_dir).withColumnRenamed("kind", "source"))


@query("D17_topology_inventory", with_views("ticks", sql=f"with {MONTHLY} select kind, month, count(*) as n, string_agg(k::varchar, ',' order by k) as instruments from monthly group by kind, month"))
def topology(spark, sf_dir):
    found = ops.topology(_monthly(spark, sf_dir))
    return found.select("kind", "month", F.size("instruments").cast("long").alias("n"), F.array_join(F.transform("instruments", lambda x: x.cast("string")), ",").alias("instruments"))


@query("E21_topology_segments", with_views("ticks", sql="""with m as (select kind, t // 259200000 as month, array_agg(distinct k % 40 order by k % 40) as s from ticks group by 1, 2),
  l as (select *, coalesce(month = lag(month) over w + 1 and s = lag(s) over w, false) as same from m window w as (partition by kind order by month)),
  n as (select *, sum(case when same then 0 else 1 end) over (partition by kind order by month) as segment from l)
  select kind, segment::bigint as segment, min(month) as first_month, max(month) as last_month, count(*) as months, first(len(s)) as instruments from n group by kind, segment"""))
def segments(spark, sf_dir):
    rows = _monthly(spark, sf_dir).withColumn("k", F.pmod("k", F.lit(40)))  # groups of instruments, so that sets repeat
    return ops.topology_segments(ops.topology(rows)).withColumn("instruments", F.col("instruments").cast("long"))


@query("E23_bounds_ambiguous", with_views("settlements", sql="""with f as (select t // 31536000000 as part, id % 4 as file, min((k, t)) as first, max((k, t)) as last from settlements group by 1, 2),
  l as (select *, max(last) over (partition by part order by first, file rows between unbounded preceding and 1 preceding) as reach from f)
  select part, file, coalesce(reach >= first, false) as ambiguous from l"""))
def bounds(spark, sf_dir):
    rows = views.settlements(spark, sf_dir).withColumns({"part": F.floor(F.col("t") / 31_536_000_000), "file": F.pmod("id", F.lit(4))})
    key = F.struct("k", "t")
    files = rows.groupBy("part", "file").agg(F.min(key).alias("a"), F.max(key).alias("b")).select(
        "part", "file", F.col("a.k").alias("first_k"), F.col("a.t").alias("first_t"), F.col("b.k").alias("last_k"), F.col("b.t").alias("last_t"))
    return ops.bounds_ambiguous(files).select("part", "file", "ambiguous")


@query("E25_strict_key_order", with_views("settlement_rows", sql="""with l as (select id % 10 as series, k, t, lag((k, t)) over (partition by id % 10 order by id) as prev from settlement_rows)
  select series, count(*) as "rows", count(*) filter ((k, t) <= prev) as violations, count(*) filter ((k, t) <= prev) = 0 as ordered from l group by series"""))
def key_order(spark, sf_dir):
    return ops.strict_key_order(views.settlement_rows(spark, sf_dir).withColumn("series", F.pmod("id", F.lit(10))), "id", "series")


@query("F6_canonical_sort", with_views("bars", sql="select k, t, close, row_number() over (partition by k % 8 order by k, t) as place from bars"))
def canonical_sort(spark, sf_dir):
    bars = views.minute_bars(spark, sf_dir).select("k", "t", "close", F.pmod("k", F.lit(8)).alias("bucket"))
    return rank_within(bars, "bucket", "k", "t").drop("bucket")


@query("G9_lineage_closure", """with recursive p(child, parent) as (select o_custkey, o_custkey // 3 from (select distinct o_custkey from orders where o_custkey > 0)),
  r(child, ancestor) as (select child, parent from p union select r.child, p.parent from r join p on r.ancestor = p.child) select child, ancestor from r""")
def lineage(spark, sf_dir):
    checkpoints(spark)
    keys = views.table(spark, sf_dir, "orders").filter("o_custkey > 0").select(F.col("o_custkey").alias("child")).distinct()
    return ops.lineage_closure(keys.withColumn("parent", F.floor(F.col("child") / 3)))


# the catalog has every other customer, some without a binding, some twice and some with two bindings
@query("G10_register_datasets", """with ex as (select c_custkey as id, case when c_custkey % 9 = 0 or c_custkey % 14 = 0 then null else c_mktsegment end as binding from customer where c_custkey % 2 = 0
    union all select c_custkey, case when c_custkey % 16 = 0 then 'TWO' when c_custkey % 9 = 0 or c_custkey % 14 = 0 then null else c_mktsegment end from customer where c_custkey % 8 = 0),
  ba as (select c_custkey as id, case when c_custkey % 10 = 0 then 'OTHER' when c_custkey % 18 = 0 then null else c_mktsegment end as binding,
    case when c_custkey % 7 = 0 then c_custkey + 1 when c_custkey % 11 = 0 then -1 end as parent from customer where c_custkey % 4 > 0 or c_custkey % 3 = 0),
  held as (select id, count(distinct coalesce(binding, '(none)')) as n, any_value(coalesce(binding, '(none)')) as binding from ex group by id), known as (select id from ex union select id from ba)
  select ba.id, ba.binding, ba.parent, case when ba.parent is not null and ba.parent not in (select id from known) then 'orphan' when h.id is null then 'new'
    when h.n = 1 and h.binding = coalesce(ba.binding, '(none)') then 'same' else 'conflict' end as state
  from ba left join held h on ba.id = h.id""")
def register(spark, sf_dir):
    customers = views.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    each = lambda n: F.pmod(key, F.lit(n)) == 0
    bound = F.when(~(each(9) | each(14)), F.col("c_mktsegment"))
    first = customers.filter(each(2)).select(key.alias("id"), bound.alias("binding"))
    again = customers.filter(each(8)).select(key.alias("id"), F.when(each(16), "TWO").otherwise(bound).alias("binding"))
    parent = F.when(each(7), key + 1).when(each(11), F.lit(-1))
    binding = F.when(each(10), "OTHER").when(~each(18), F.col("c_mktsegment"))
    batch = customers.filter(~each(4) | each(3)).select(key.alias("id"), binding.alias("binding"), parent.alias("parent"))
    return ops.register(first.unionByName(again), batch)
