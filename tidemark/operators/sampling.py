"""Rankings, even samples of ranks, probe windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.exact import tick_round
from tidemark.functions.times import DAY, MINUTE
from tidemark.operators.ranks import global_rank


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """rows with their place from 0 in a total order and their number `n`; for pools of a bounded number of rows."""
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long") - 1).withColumn("n", F.count("*").over(Window.partitionBy()))


def even_rank_sample(rows: DataFrame, order: list, count: int) -> DataFrame:
    """`count` rows at evenly spaced ranks of the order, ends included."""
    placed, n = global_rank(rows, *order)
    return placed.filter(F.col("rank").isin([i * (n - 1) // (count - 1) for i in range(count)] if n else []))


def _even_in_pool(rows: DataFrame, order: list, count: int) -> DataFrame:
    spaced = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.floor(i * (F.col("n") - 1) / (count - 1)))
    return ranked(rows, order).filter(F.array_contains(spaced, F.col("rank"))).drop("n")


def liquid_price_sample(instruments: DataFrame, count: int, least_pool: int) -> DataFrame:
    """`count` instruments at even price ranks of the most liquid max(least_pool, 10 * count)."""
    pool = instruments.orderBy(F.desc("turnover"), "symbol").limit(max(least_pool, 10 * count))
    return _even_in_pool(pool, ["price", "symbol"], count)


def shortlist(instruments: DataFrame, most: int, tick: int = 25, padding: int = 20, spread_bps: int = 5, range_permille: int = 150) -> DataFrame:
    """The `most` instruments (symbol, price, size, low, high, bid, ask, turnover) that pass the thresholds, by smallest order, then turnover.

    Thresholds are of price, smallest order and turnover, of the spread against the price (spread_bps) and of the day's
    range against it (range_permille). Each has tick-rounded, padded bounds: stop < lower < upper < take, all positive;
    instruments whose ticker is inverted, or whose rounded bounds aren't in that order, are left out.
    """
    minimum = F.greatest(F.col("size") * F.col("price"), F.lit(50_000))
    fits = F.col("price").between(90_000, 180_000) & (minimum <= 900_000) & (F.col("turnover") >= 1_000_000) & (F.col("high") >= F.col("low")) & (F.col("ask") >= F.col("bid"))
    calm = ((F.col("ask") - F.col("bid")) * 10_000 <= F.col("price") * spread_bps) & ((F.col("high") - F.col("low")) * 1000 <= F.col("price") * range_permille)
    below = lambda c: tick_round(F.col(c) - F.floor(F.col(c) / padding), F.lit(tick))
    above = lambda c: tick_round(F.col(c) + F.floor(F.col(c) / padding), F.lit(tick), up=True)
    bounded = instruments.filter(fits & calm).withColumns({"minimum_order": minimum, "lower": below("low"), "upper": above("high")})
    bounded = bounded.withColumns({"stop": below("lower"), "take": above("upper")}).filter("0 < stop and stop < lower and lower < upper and upper < take")
    listed = bounded.orderBy("minimum_order", F.desc("turnover"), "symbol").limit(most)
    return listed.select("symbol", "minimum_order", "turnover", "stop", "lower", "upper", "take")


def oldest_instruments(records: DataFrame, count: int, end_ms: int, pages: int, page_minutes: int = 1000) -> DataFrame:
    """The first `count` trading instruments by (launch, symbol) that are old enough for so many pages before end_ms.

    records (symbol, contract, quote, settle, status, launch): linear perpetuals quoted and settled in USDT alone take part, and
    a symbol that two of them share, or an empty one, is an error, raised when the query runs. Null or negative launches
    don't qualify.
    """
    linear = records.filter("contract = 'LinearPerpetual' and quote = 'USDT' and settle = 'USDT'")
    single = F.assert_true((F.count("*") == 1) & (F.coalesce(F.length("symbol"), F.lit(0)) > 0), F.concat(F.lit("empty or repeated symbol "), F.coalesce("symbol", F.lit("null"))))
    unique = linear.groupBy("symbol").agg(F.first("status").alias("status"), F.first("launch").alias("launch"), single.alias("__ok")).filter("__ok is null")
    needed = end_ms - (pages * page_minutes - 1) * MINUTE
    return unique.filter((F.col("status") == "Trading") & F.col("launch").between(0, needed)).orderBy("launch", "symbol").limit(count).select("symbol", "launch")


def probe_windows(targets: DataFrame, launch_minutes: int = 1000, period_ms: int = 365 * DAY, length_ms: int = 7 * DAY) -> DataFrame:
    """(k, kind, start, stop; both inclusive) of the windows of targets (k, start, stop) that are probed.

    `launch`: the first launch_minutes; `annual`: length_ms at each full period_ms after the start; `terminal`: the last length_ms,
    but not before the launch window's end, unless an annual window or the launch ends there. All are clipped to the stop.
    """
    begin, end, step = F.col("start"), F.col("stop"), F.lit(period_ms)
    launch_end = F.least(end, begin + (launch_minutes - 1) * MINUTE)
    window = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("start"), b.alias("stop"))
    none = F.array().cast("array<struct<kind:string,start:bigint,stop:bigint>>")
    starts = F.when(begin + period_ms <= end, F.sequence(begin + period_ms, end, step))
    annual = F.coalesce(F.transform(starts, lambda s: window("annual", s, F.least(end, s + length_ms - MINUTE))), none)
    open_end = (launch_end < end) & F.coalesce(F.array_max(F.transform(annual, lambda w: w["stop"])) < end, F.lit(True))
    last = F.when(open_end, F.array(window("terminal", F.greatest(launch_end + MINUTE, end - length_ms + MINUTE), end))).otherwise(none)
    made = targets.filter("start <= stop").withColumn("annual", annual)
    every = F.concat(F.array(window("launch", begin, launch_end)), annual, last)
    return made.select("k", F.explode(every).alias("w")).select("k", "w.*")


def probe_results(windows: DataFrame, rows: DataFrame) -> DataFrame:
    """(k, kind, start, stop, observed, first_t, delay_ms) of windows: rows (k, t) inside, the earliest and how late it is.

    An instrument's windows, a dozen or so, meet its rows as one array, so no row is repeated for windows that it isn't in.
    """
    window = F.struct("kind", "start", "stop")
    gathered = windows.groupBy("k").agg(F.collect_list(window).alias("windows"))
    inside = rows.select("k", "t").join(gathered, "k").select("k", "t", F.explode(F.filter("windows", lambda w: F.col("t").between(w["start"], w["stop"]))).alias("w"))
    found = inside.groupBy("k", "w").agg(F.count("*").alias("observed"), F.min("t").alias("first_t")).select("k", "w.*", "observed", "first_t")
    met = windows.join(found, ["k", "kind", "start", "stop"], "left")
    return met.select("k", "kind", "start", "stop", F.coalesce("observed", F.lit(0)).alias("observed"), "first_t", (F.col("first_t") - F.col("start")).alias("delay_ms"))
