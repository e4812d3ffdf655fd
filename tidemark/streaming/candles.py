"""Structured Streaming forms of the live candle rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def closed_candles(ticks: DataFrame, late: str = "2 minutes") -> DataFrame:
    """Closed one-minute bars of a stream of ticks (k, ts, price, event_id); later ticks than `late` are dropped."""
    at = F.struct("ts", "event_id")
    bars = ticks.withWatermark("ts", late).groupBy("k", F.window("ts", "1 minute").alias("w")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.count("*").alias("volume"))
    return bars.select("k", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume")


def dedupe(rows: DataFrame, late: str = "2 minutes") -> DataFrame:
    """One row for each (k, ts) of a stream within the watermark, whatever is replayed."""
    return rows.withWatermark("ts", late).dropDuplicatesWithinWatermark(["k", "ts"])


def gap_flags(bars: DataFrame, late: str = "2 minutes", silence: str = "1 day") -> DataFrame:
    """(k, ts, gap_minutes, silent) of a stream of bars (k, ts): minutes that are missing before a bar.

    The state is each instrument's latest bar; rows at or before it flag 0, rows behind the watermark are dropped. An
    instrument whose bars stop for `silence` of event time gives a row with its last bar and silent true, and its state
    goes; its next bar is a first one again.
    """
    from .processors import GapFlags, milliseconds, on_rocksdb

    on_rocksdb(bars.sparkSession)
    keyed = bars.withWatermark("ts", late).select("k", "ts", F.unix_millis("ts").alias("ms")).groupBy("k")
    flags = keyed.transformWithStateInPandas(GapFlags(milliseconds(silence)), "k long, ms long, gap_minutes long, silent boolean", "Append", "EventTime")
    return flags.select("k", F.timestamp_millis("ms").alias("ts"), "gap_minutes", "silent")


def complete_minutes(parts: DataFrame, inputs: tuple[str, ...], late: str = "2 minutes", wait: str = "1 minute") -> DataFrame:
    """(k, ts, complete, missing, a column for each input) of a stream of parts (k, ts, input, value): one row a minute.

    No row goes out until a minute has all its inputs; then it goes at once, complete. `wait` after a minute's end, in
    event time, it goes as it is: incomplete, with the names of the missing inputs. The first value of an input counts, so
    replays change nothing; rows behind the watermark and of inputs that aren't named are dropped. A minute's state goes
    when its time is over.
    """
    from .processors import MinuteBarrier, milliseconds, on_rocksdb

    on_rocksdb(parts.sparkSession)
    named = parts.filter(F.col("input").isin(*inputs)).withWatermark("ts", late)
    minute = F.unix_millis("ts") - F.pmod(F.unix_millis("ts"), F.lit(60_000))
    keyed = named.select("k", "ts", minute.alias("minute"), "input", F.col("value").cast("double").alias("value")).groupBy("k")
    schema = "k long, minute long, complete boolean, missing string, " + ", ".join(f"`{i}` double" for i in inputs)
    made = keyed.transformWithStateInPandas(MinuteBarrier(inputs, milliseconds(wait)), schema, "Append", "EventTime")
    return made.select("k", F.timestamp_millis("minute").alias("ts"), "complete", "missing", *[f"`{i}`" for i in inputs])


def first_seen(rows: DataFrame, keep: str = "1 hour") -> DataFrame:
    """The rows (k, ts, ...) of a stream whose (k, ts) wasn't seen within `keep` of processing time, late or not.

    Where a source replays old rows that a watermark would drop with the new ones. Keys are map state by instrument that
    expires by itself. Spark runs such a query's batches whether or not there are rows, so stop it or let it run once:
    with availableNow it doesn't end.
    """
    from .processors import SeenKeys, milliseconds, on_rocksdb

    on_rocksdb(rows.sparkSession)
    schema = rows.schema
    return rows.groupBy("k").transformWithStateInPandas(SeenKeys(milliseconds(keep)), schema, "Append", "ProcessingTime")
