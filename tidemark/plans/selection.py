"""Queries of file selection through manifests, of its refusals and of lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.times import HOUR
from tidemark.operators import selection as ops
from tidemark.plans.catalog import BAR_SCHEMA, scratch
from tidemark.plans.registry import query
from tidemark.plans.sql import with_views
from tidemark.sources import canonical, views

MIDDLE = 1_705_276_800_000  # where the second dataset begins
RANGE = (1_704_585_600_000, 1_706_140_800_000)
IDS = [3, 11, 19, 42, 77]


def _stored(spark, sf_dir, overlap_ms=0):
    """The bars as two datasets, `early` and `late`, that share the last overlap_ms before MIDDLE; their manifest."""
    bars = views.minute_bars(spark, sf_dir).select(*BAR_SCHEMA.names)
    manifests = []
    for name, rows in (("early", bars.filter(F.col("t") < MIDDLE)), ("late", bars.filter(F.col("t") >= MIDDLE - overlap_ms))):
        path = scratch(spark, name)
        canonical.write_canonical(rows, path)
        manifests.append(ops.file_manifest(canonical.read_canonical(spark, path, BAR_SCHEMA), name))
    return manifests[0].unionByName(manifests[1])


@query("A8_read_selection", with_views("bars", sql=f"select k, t, close from bars where t between {RANGE[0]} and {RANGE[1]} and k in ({', '.join(map(str, IDS))})"))
def read_selection(spark, sf_dir):
    lineage = spark.createDataFrame([("late", "raw"), ("early", "raw")], "child string, parent string")
    datasets = spark.createDataFrame([("early",), ("late",), ("raw",)], "id string")
    return ops.read_selection(_stored(spark, sf_dir), lineage, datasets, ["early", "late"], BAR_SCHEMA, *RANGE, IDS).select("k", "t", "close")


# two months more than the table has on either side
@query("A8_missing_partitions", with_views("bars", sql="""with asked as (select year, month, bucket from (values (2023, 11), (2023, 12), (2024, 1), (2024, 2), (2024, 3)) m(year, month), range(8) b(bucket)),
  there as (select distinct extract(year from epoch_ms(t)) as year, extract(month from epoch_ms(t)) as month, k % 8 as bucket from bars)
  select 'missing_partition' as fault, printf('year=%04d/month=%02d/bucket=%02d', year, month, bucket) as what from asked a
  where not exists (select 1 from there h where h.year = a.year and h.month = a.month and h.bucket = a.bucket)"""))
def missing_partitions(spark, sf_dir):
    return ops.partition_faults(_stored(spark, sf_dir), 1_698_796_800_000, 1_711_929_599_999)


@query("G2_shared_keys", with_views("bars", sql=f"select k, t, 2::bigint as n from bars where t >= {MIDDLE - 6 * HOUR} and t < {MIDDLE}"))
def shared_keys(spark, sf_dir):
    files = ops.select_files(_stored(spark, sf_dir, overlap_ms=6 * HOUR), *RANGE)
    return ops.shared_keys(spark, files, BAR_SCHEMA)[0]


@query("E23_overlap_clusters", with_views("settlements", sql="""with f as (select t // 7776000000 as year, k % 4 as month, id % 5 as bucket, id % 3 as file, min((k, t)) as first, max((k, t)) as last from settlements where (id + k) % 7 = 0 group by 1, 2, 3, 4),
  l as (select *, max(last) over (partition by year, month, bucket order by first, last, file rows between unbounded preceding and 1 preceding) as reach from f),
  n as (select *, sum(case when first > reach or reach is null then 1 else 0 end) over (partition by year, month, bucket order by first, last, file)::bigint as cluster from l)
  select year, month, bucket, file, cluster, count(*) over (partition by year, month, bucket, cluster) as of_cluster from n"""))
def overlap_clusters(spark, sf_dir):
    rows = views.settlements(spark, sf_dir).filter("(id + k) % 7 = 0").withColumns({
        "year": F.floor(F.col("t") / 7_776_000_000), "month": F.pmod("k", F.lit(4)), "bucket": F.pmod("id", F.lit(5)), "file": F.pmod("id", F.lit(3))})
    key = F.struct("k", "t")
    files = rows.groupBy("year", "month", "bucket", "file").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    return ops.overlap_groups(files).drop("first", "last")


# a dataset for each customer, made from that of a third of its number; some name each other, some a parent that isn't there
@query("G9_selection_faults", """with recursive edges as (select c_custkey as child, c_custkey // 3 as parent from customer where c_custkey > 0 union select c_custkey, -c_custkey from customer where c_custkey % 50 = 3
    union select c_custkey, c_custkey + 1 from customer where c_custkey % 100 = 7 union select c_custkey + 1, c_custkey from customer where c_custkey % 100 = 7),
  chosen as (select c_custkey as id from customer where c_custkey % 97 = 5 or c_custkey % 100 = 2 union select -5),
  up(id, ancestor) as (select id, parent from chosen join edges on child = id union select u.id, e.parent from up u join edges e on e.child = u.ancestor),
  reached as (select id from chosen union select ancestor from up),
  around(id, ancestor) as (select id, parent from reached join edges on child = id union select a.id, e.parent from around a join edges e on e.child = a.ancestor)
  select 'not_registered' as fault, id::varchar as what from chosen where id not in (select c_custkey from customer)
  union all select 'missing_parent', parent || ' of ' || child from edges where child in (select id from reached) and parent not in (select c_custkey from customer)
  union all select 'cycle', id::varchar from around where id = ancestor
  union all select 'ancestor_selected', ancestor || ' of ' || id from up where id <> ancestor and ancestor in (select id from chosen)""")
def selection_faults(spark, sf_dir):
    key = F.col("c_custkey")
    customers = views.table(spark, sf_dir, "customer").select(key)
    edge = lambda child, parent: (child.alias("child"), parent.alias("parent"))
    pairs = customers.filter("c_custkey % 100 = 7")
    lineage = (customers.filter("c_custkey > 0").select(*edge(key, F.floor(key / 3))).unionByName(customers.filter("c_custkey % 50 = 3").select(*edge(key, -key)))
               .unionByName(pairs.select(*edge(key, key + 1))).unionByName(pairs.select(*edge(key + 1, key))))
    chosen = customers.filter("c_custkey % 97 = 5 or c_custkey % 100 = 2").select(key.alias("id")).unionByName(spark.range(1).select(F.lit(-5).cast("long").alias("id")))
    return ops.lineage_faults(lineage, customers.select(key.alias("id")), chosen)
