"""Exact duplicates by sorting contents: sampled range partitions, external sort, neighbouring comparisons."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE_CLASS, materialise

#: Leading characters of the normalised text that the sampled splitters hold; ties go by digest and id.
SPLITTER_CHARS = 48


def normalise(text: Column) -> Column:
    """Each run of [\\x20\\x09-\\x0D] as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", " ")


def _mark_runs(batches: Iterator) -> Iterator:
    """Number the runs of equal neighbours in this sorted partition; see _marked()."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    part, run, first_id, last = TaskContext.get().partitionId(), -1, None, None
    held = []

    def out(batch, runs, new, firsts, edge_text):
        extra = [pa.array(np.full(len(runs), part), pa.int32()), pa.array(runs, pa.int64()), pa.array(new), firsts, edge_text]
        names = ["__part", "__run", "__lead", "__first", "__edge"]
        keep = [i for i, n in enumerate(batch.schema.names) if n != "__norm"]
        columns = [batch.column(i) for i in keep] + extra
        return pa.RecordBatch.from_arrays(columns, names=[batch.schema.names[i] for i in keep] + names)

    for batch in batches:
        if not batch.num_rows:
            continue
        norm, ids = batch.column("__norm"), batch.column("__id")
        new = np.ones(batch.num_rows, dtype=bool)
        if batch.num_rows > 1:
            new[1:] = pc.not_equal(norm.slice(1), norm.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        new[0] = last is None or norm[0].as_py() != last
        runs = run + np.cumsum(new)
        starts = np.flatnonzero(new)
        which = np.maximum.accumulate(np.where(new, np.arange(batch.num_rows), 0))
        firsts = ids.take(pa.array(which))
        if not new[0]:
            until = starts[0] if len(starts) else batch.num_rows
            firsts = pa.concat_arrays([pa.array([first_id] * until, ids.type), firsts.slice(until)])
        # of the partition only the first and the last text are kept, for comparison with the neighbours
        edges = [None] * batch.num_rows
        if run < 0:
            edges[0] = norm[0].as_py()
        last, run, first_id = norm[-1].as_py(), int(runs[-1]), firsts[-1].as_py()
        if held:
            yield held.pop()
        held.append(out(batch, runs, new, firsts, pa.array(edges, pa.string())))
    if held:
        batch = held.pop()
        edge = batch.column(batch.num_columns - 1).to_pylist()
        edge[-1] = last
        columns = [*batch.columns[:-1], pa.array(edge, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


RESULTS = ("keep_id", "group_size", "kept", "text_sha256")


def _marked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """Rows of docs in content order with the run of equals that each is in, written to the shared folder.

    Rows are dealt into ranges of (first SPLITTER_CHARS characters of the normalised text, digest, id) by
    splitters that Spark samples, so that copies of one text may fill many ranges, and are sorted there by
    (those characters, digest, text, id) with spilling. A pass over each sorted partition compares every
    text with its neighbour and numbers the runs of equals.
    """
    payload = [c for c in docs.columns if c not in RESULTS]
    rows = docs.select(*payload, F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    text = normalise(F.col("__text"))
    ranged = rows.repartitionByRange(F.substring(text, 1, SPLITTER_CHARS), F.sha2(text.cast("binary"), 256), F.col("__id").asc_nulls_last())
    ready = ranged.withColumn("__norm", text).drop("__text")
    ready = ready.withColumn("text_sha256", F.sha2(F.col("__norm").cast("binary"), 256))
    ready = ready.sortWithinPartitions(F.substring("__norm", 1, SPLITTER_CHARS), "text_sha256", "__norm", F.col("__id").asc_nulls_last())
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema.fields if f.name != "__norm")
    id_type = ready.schema["__id"].dataType.simpleString()
    schema = f"{kinds}, __part int, __run long, __lead boolean, __first {id_type}, __edge string"
    return materialise(ready.mapInArrow(_mark_runs, schema), "dedup-runs"), payload


def _chains(marked: DataFrame) -> DataFrame:
    """Runs at the ends of ranges joined to those that they go on from; two rows for each range at most.

    The ends are lined up by their numbers alone, and the texts of neighbouring ends meet in a join on those.
    Returns (__part, __run, __chain_first, __chain_n, __link), __link 1 where a chain begins.
    """
    ends = marked.filter(F.col("__edge").isNotNull()).groupBy("__part", "__run").agg(F.max("__edge").alias("edge"))
    line = Window.orderBy("__part", "__run")  # two rows of integers for each range
    before = F.lag(F.struct("__part", "__run")).over(line)
    order = marked.filter(F.col("__edge").isNotNull()).select("__part", "__run").distinct().withColumn("before", before)
    previous = ends.select(F.col("__part").alias("part"), F.col("__run").alias("run"), F.col("edge").alias("text"))
    met = order.join(ends, ["__part", "__run"]).join(previous, (F.col("before.__part") == F.col("part")) & (F.col("before.__run") == F.col("run")), "left")
    begins = met.select("__part", "__run", F.coalesce(F.col("edge") != F.col("text"), F.lit(True)).cast("int").alias("begins"))
    sizes = marked.groupBy("__part", "__run").agg(F.count("*").alias("n"), F.first("__first").alias("first"))
    chained = begins.join(sizes, ["__part", "__run"]).withColumn("chain", F.sum("begins").over(line))
    inside = Window.partitionBy("chain").orderBy("__part", "__run")
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return chained.select("__part", "__run", F.first("first").over(whole).alias("__chain_first"),
                          F.sum("n").over(whole).alias("__chain_n"), F.row_number().over(inside).alias("__link"))


def _is_kept() -> Column:
    return F.col("__lead") & (F.coalesce("__link", F.lit(1)) == 1)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs with keep_id, group_size, kept and text_sha256, its text compared by content.

    See _marked() for the sort. A run that ends a range may go on in the next one: the first and the last
    text of every range are compared and joined into chains, whose ids and counts come back to their rows
    by a join on (range, run). No group is ever gathered.

    Of equal texts the smallest id is kept. A null text counts as empty; a null id comes after all others,
    and keep_id is null only where a group has no other. Of rows with equal texts and equal ids one is kept.
    Columns of docs with the names of the results are replaced. An empty table gives no rows.
    """
    marked, payload = _marked(docs, id_col, text_col)
    sizes = marked.groupBy("__part", "__run").agg(F.count("*").alias("__n"))
    joined = marked.drop("__edge").join(sizes, ["__part", "__run"]).join(_chains(marked), ["__part", "__run"], "left")
    return joined.select(
        *payload,
        F.when(F.col("__link").isNull(), F.col("__first")).otherwise(F.col("__chain_first")).alias("keep_id"),
        F.coalesce("__chain_n", "__n").alias("group_size"),
        _is_kept().alias("kept"),
        "text_sha256",
    )


def exact_dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows only, with the columns of docs; the same choice as exact_dedup()."""
    marked, payload = _marked(docs, id_col, text_col)
    leads = marked.filter("__lead").drop("__edge").join(_chains(marked).select("__part", "__run", "__link"), ["__part", "__run"], "left")
    return leads.filter(_is_kept()).select(*payload)
