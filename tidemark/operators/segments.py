"""Segmented scans: each instrument's history in blocks of time that tasks finish alone, with a halo of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.times import DAY

#: Rows of a block at least, where the instrument has so many.
BLOCK_ROWS = 1 << 14
#: Rows that a task works on together, besides a block.
BATCH_ROWS = 1 << 16


def block_plan(rows: DataFrame, back: int, ahead: int = 0, unit: int = DAY) -> DataFrame:
    """For each (k, unit of time) of rows (k, t): its block, and the neighbours that need it as a halo.

    Units are counted first, a row for each, and running counts cut every history into blocks: of BLOCK_ROWS rows,
    eight halos, or a halo and the fullest unit, whichever is most. So a block has at least a halo's rows, unless it
    is an instrument's last, and no unit is in the halo of two blocks on one side. Returns (k, __unit, __to), the
    blocks that the unit's rows go to as (block, own): its own, the one after if the unit is in the `back` rows before
    that, and the one before if it is in the `ahead` rows behind that.
    """
    counts = rows.groupBy("k", (F.col("t") - F.pmod("t", F.lit(unit))).alias("__unit")).agg(F.count("*").alias("n"))
    line = Window.partitionBy("k").orderBy("__unit")
    halo = max(back, ahead)
    size = F.greatest(F.lit(max(BLOCK_ROWS, 8 * halo)), F.max("n").over(Window.partitionBy("k")) + halo).cast("long")
    placed = counts.withColumns({"upto": F.sum("n").over(line), "size": size}).withColumn("from", F.col("upto") - F.col("n"))
    placed = placed.withColumn("__block", F.expr("`from` div size"))
    block, order = Window.partitionBy("k", "__block"), Window.partitionBy("k").orderBy("__block")
    placed = placed.withColumns({
        "first": F.min("from").over(block), "last": F.max("upto").over(block),
        "after": F.min("__block").over(order.rangeBetween(1, Window.unboundedFollowing)),
        "ahead": F.max("__block").over(order.rangeBetween(Window.unboundedPreceding, -1))})
    targets = [(F.lit(True), F.col("__block"), True)]
    if back:
        targets.append(((F.col("last") - F.col("upto") < back) & F.col("after").isNotNull(), F.col("after"), False))
    if ahead:
        targets.append(((F.col("from") - F.col("first") < ahead) & F.col("ahead").isNotNull(), F.col("ahead"), False))
    sent = F.array(*[F.when(needed, F.struct(to.alias("block"), F.lit(own).alias("own"))) for needed, to, own in targets])
    return placed.select("k", "__unit", F.array_compact(sent).alias("__to"))


def scan_segments(rows: DataFrame, finish: Callable, schema: str, back: int, ahead: int = 0, unit: int = DAY) -> DataFrame:
    """rows (k, t, ...) with the columns of `schema` that finish() adds, computed block by block.

    See block_plan(). Each row goes to its block and, where it is in a halo, to a neighbour, in one shuffle by block.
    Sorted partitions are then read as a stream of whole segments (a block with its halo): finish(table, place, left) gets
    an Arrow table of some in order of (k, block, t), and for every row how many of its segment are before and after it,
    and returns the added columns; it may look `back` rows back and `ahead` rows on inside the segment. Rows of the halo are left out of
    the result. A task holds a segment and BATCH_ROWS rows at most. Rows without k or t belong to no history and are
    left out; rows that share (k, t) are in any order.
    """
    unit_of = (F.col("t") - F.pmod("t", F.lit(unit))).alias("__unit")
    planned = rows.select("*", unit_of).join(block_plan(rows, back, ahead, unit), ["k", "__unit"])
    sent = planned.withColumn("__to", F.explode("__to"))
    dealt = sent.select(*rows.columns, F.col("__to.block").alias("__block"), F.col("__to.own").alias("__own"))
    dealt = dealt.repartition("k", "__block").sortWithinPartitions("k", "__block", "t")
    columns = list(rows.columns)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def starts(table):
            """Where segments begin."""
            changed = np.zeros(len(table), bool)
            for name in ("k", "__block"):
                values = table.column(name)
                changed[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False).astype(bool)
            return np.concatenate([[0], np.flatnonzero(changed)]).astype(np.int64)

        def done(table, begins):
            sizes = np.diff(np.concatenate([begins, [len(table)]]))
            place = np.arange(len(table)) - np.repeat(begins, sizes)
            made = [*(table.column(n) for n in columns), *finish(table, place, np.repeat(sizes, sizes) - 1 - place)]
            return pa.RecordBatch.from_arrays(made, names=[*columns, *added]).filter(table.column("__own"))

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < BATCH_ROWS:
                continue
            table = pa.concat_batches(held)
            begins = starts(table)
            if begins[-1]:  # the last segment may go on
                yield done(table.slice(0, begins[-1]), begins[:-1])
            held = [table.slice(begins[-1])]
            size = held[0].num_rows
        if size:
            table = pa.concat_batches(held)
            yield done(table, starts(table))

    added = [part.split()[0] for part in schema.split(",")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return dealt.mapInArrow(run, f"{kinds}, {schema}")


def numbers(table, name: str):
    """A column as 64-bit integers, or as floats with NaN for null."""
    import numpy as np

    values = table.column(name).to_numpy(zero_copy_only=False)
    return values.astype(np.int64 if values.dtype.kind in "iub" else np.float64)


def rolling_sum(values, rows: int, place):
    """Sum of the last `rows` values of a segment, nulls left out; 0 where there are fewer."""
    import numpy as np

    if values.dtype.kind == "f":
        values = np.nan_to_num(values)
    run = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    made = np.zeros(len(values), values.dtype)
    made[rows - 1 :] = run[rows:] - run[:-rows]
    return np.where(place >= rows - 1, made, 0)


def rolling_extreme(values, rows: int, extreme: Callable):
    """np.fmax or np.fmin of the last `rows` values at each place, by doubling; places with fewer have any value."""
    import numpy as np

    whole, width = values, 1  # whole[i]: the extreme of values i to i + width - 1
    while 2 * width <= rows:
        whole, width = extreme(whole[:-width], whole[width:]), 2 * width
        if not len(whole):
            return values.copy()
    made = values.copy()
    if len(values) >= rows:
        made[rows - 1 :] = extreme(whole[: len(values) - rows + 1], whole[rows - width : rows - width + len(values) - rows + 1])
    return made


def shifted(values, by: int):
    """The value `by` rows before (or, negative, after) each; the ends keep their own."""
    import numpy as np

    made = values.copy()
    if by > 0:
        made[by:] = values[:-by] if by < len(values) else made[by:]
    elif -by < len(values):
        made[:by] = values[-by:]
    return np.asarray(made)


def column(values, known, kind: str):
    """An Arrow column of the values where `known`, null elsewhere and where they are NaN; kind: long or double."""
    import numpy as np
    import pyarrow as pa

    missing = ~known
    if values.dtype.kind == "f":
        missing = missing | np.isnan(values)
    if kind == "long":
        values = np.where(missing, 0, values).astype(np.int64)
    return pa.array(values, {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[kind], mask=missing)
