"""Mixing sources to target weights by hash thresholds found from nested histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise

#: Hash bits in all and bits that one histogram level resolves.
HASH_BITS, LEVEL_BITS = 48, 12
#: No document is taken more often, and no source beyond this multiple of its size.
MOST = 3
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in the text, 0 for null: the places where a word begins."""
    begins = F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]"))
    return F.coalesce(begins, F.lit(0)).cast("long")


def mix_hash(id_col: Column) -> Column:
    """A 48-bit hash of the id as text; null counts as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, source_col: str, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, budget) for rows of (source, size).

    Sources share the sum of all sizes by weight; a target stops at `most` times its source's size and the
    excess is shared again by weight until none is above. With sources in the order of source_size/weight
    that is one pass: the capped ones are a prefix, and the level of the rest follows from the sums.
    Windows here see a row for each source, never a row for each document.
    """
    by_source = sizes.groupBy(source_col).agg(F.sum("size").alias("source_size"))
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    named = by_source.withColumn("place", F.row_number().over(Window.orderBy(F.col(source_col).asc_nulls_last())))
    named = named.withColumn("weight", pick.cast("long")).withColumn("cap", F.col("source_size") * most)
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before, whole = ordered.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    sums = named.withColumns({
        "left": F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "shares": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    capped = sums.withColumn("capped", F.col("cap") * F.col("shares") <= F.col("left") * F.col("weight"))
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "place", "left", "shares"))).over(whole)
    level = capped.withColumn("free", free)
    even = (F.col("weight") * F.col("free.left")).cast("double") / F.col("free.shares")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(even)
    return level.select(source_col, "source_size", target.alias("target"), F.floor(target).alias("budget"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Sizes and how often each document is taken: ((id, __source, size, __hash), plan for each source).

    The plan has source_size, target, `full` (times every document of the source is taken) and `cut`
    (documents whose hash is below it are taken once more). `cut` comes from nested histograms: sums of
    sizes for each source and the first LEVEL_BITS bits of the hash give the bucket where the rest of the
    budget runs out; only that bucket's documents are summed at the next bits, until the hash is resolved.
    The document at the cut is taken when that comes nearer to the budget. Nothing is sorted or sampled.

    Equal ids share a hash and so a decision. Null sources are a source of their own, after all others;
    null ids hash as empty text; texts that are null or have no word have size 0 and are taken 0 words.
    An empty table gives empty results.
    """
    sizes = docs.select(F.col(id_col), F.col(source_col).alias("__source"), word_count(F.col(text_col)).alias("size"))
    sizes = materialise(sizes.withColumn("__hash", mix_hash(F.col(id_col))), "mix-sizes")
    plan = source_targets(sizes, "__source", weights, most)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("full", full.cast("long")).withColumn("need", F.col("budget") - F.col("full") * F.col("source_size"))
    zero = F.lit(0).cast("long")
    plan = materialise(plan.withColumns({"bucket": zero, "got": zero, "in_bucket": zero}), "mix-plan")
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        boundary = plan.select(F.col("__source").alias("__s"), F.col("bucket").alias("__in"))
        inside = sizes.join(boundary, F.col("__source").eqNullSafe(F.col("__s")) & (F.shiftright("__hash", shift + LEVEL_BITS) == F.col("__in")))
        histogram = inside.groupBy("__s", F.shiftright("__hash", shift).alias("b")).agg(F.sum("size").alias("sum"))
        below = F.sum("sum").over(Window.partitionBy("__s").orderBy("b")) - F.col("sum")
        met = plan.join(histogram.withColumn("below", below), F.col("__source").eqNullSafe(F.col("__s")) & (F.col("got") + F.col("below") <= F.col("need")))
        last = met.groupBy(F.col("__source").alias("__s")).agg(F.max(F.struct("b", "below", "sum")).alias("last"))
        plan = materialise(plan.join(last, F.col("__source").eqNullSafe(F.col("__s")), "left").select(
            "__source", "source_size", "target", "budget", "full", "need",
            F.coalesce("last.b", F.shiftleft("bucket", LEVEL_BITS)).alias("bucket"),
            (F.col("got") + F.coalesce("last.below", zero)).alias("got"),
            F.coalesce("last.sum", zero).alias("in_bucket"),
        ), "mix-plan")
    nearer = F.col("got") + F.col("in_bucket") - F.col("need") <= F.col("need") - F.col("got")
    cut = F.when(F.col("full") < most, F.col("bucket") + nearer.cast("long")).otherwise(zero)
    return sizes, plan.select("__source", "source_size", "target", "full", cut.alias("cut"))


def copies() -> Column:
    """How often a document is taken, on rows that have __hash and the plan's columns."""
    return F.col("full") + F.when(F.col("__hash") < F.col("cut"), F.lit(1)).otherwise(F.lit(0))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """(id, size, source_size, target, taken) for every document; see mix()."""
    sizes, plan = mix(docs, **options)
    joined = sizes.join(plan.withColumnRenamed("__source", "__s"), F.col("__source").eqNullSafe(F.col("__s")))
    taken = (F.col("size") * copies()).cast("long")
    return joined.select(sizes.columns[0], "size", "source_size", "target", taken.alias("taken"))


def mix_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The mixture itself: each row of docs as often as it is taken, with its own columns."""
    _, plan = mix(docs, id_col=id_col, source_col=source_col, **options)
    plan = plan.select(F.col("__source").alias("__s"), "full", "cut").select(F.struct("full", "cut").alias("__plan"), "__s")
    joined = docs.join(plan, docs[source_col].eqNullSafe(F.col("__s")))
    again = F.when(mix_hash(docs[id_col]) < F.col("__plan.cut"), F.lit(1)).otherwise(F.lit(0))
    times = (F.col("__plan.full") + again).cast("int")
    return joined.filter(times > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), times))).select(*[docs[c] for c in docs.columns])
