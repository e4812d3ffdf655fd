"""Streams of bars with replays, late rows, restarts from the checkpoint and state that expires."""

import datetime as dt

import pytest

from tidemark.streaming import candles

BASE = dt.datetime(2026, 1, 1)
TICKS = "k long, ts timestamp, price double, event_id long"
PARTS = "k long, ts timestamp, input string, value double"


def at(minutes):
    return BASE + dt.timedelta(minutes=minutes)


class Stream:
    """A folder of files, and what a query over it has written; every run() is a restart from the checkpoint."""

    def __init__(self, spark, folder, schema, make, **trigger):
        self.spark, self.folder, self.schema, self.make, self.trigger = spark, folder, schema, make, trigger or {"availableNow": True}

    def put(self, *rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        return self.run()

    def run(self):
        source = self.spark.readStream.schema(self.schema).parquet(f"{self.folder}/in")
        query = self.make(source).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{self.folder}/checkpoint")
        query.option("path", f"{self.folder}/out").trigger(**self.trigger).start().awaitTermination(300)
        return self.spark.read.parquet(f"{self.folder}/out")


@pytest.fixture(autouse=True)
def store(spark):
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_closed_candles_and_dedupe(spark, tmp_path):
    ticks = [(1, BASE + dt.timedelta(seconds=s), float(s), s) for s in (1, 30, 61, 300, 900)]
    closed = Stream(spark, tmp_path / "closed", TICKS, candles.closed_candles).put(*ticks)
    rows = sorted((r.open, r.close, r.volume) for r in closed.collect())
    assert rows[0] == (1.0, 30.0, 2) and (61.0, 61.0, 1) in rows
    assert Stream(spark, tmp_path / "deduped", TICKS, candles.dedupe).put(*ticks, *ticks[:2]).count() == 5


def test_gap_flags_over_restarts(spark, tmp_path):
    stream = Stream(spark, tmp_path, "k long, ts timestamp", lambda s: candles.gap_flags(s, silence="1 hour"))
    flags = lambda out: sorted((r.k, r.ts, r.gap_minutes, r.silent) for r in out.collect())
    first = [(1, at(0), 0, False), (1, at(1), 0, False), (1, at(5), 3, False), (2, at(2), 0, False)]
    assert flags(stream.put((1, at(5)), (1, at(0)), (2, at(2)), (1, at(1)))) == first
    again = [(1, at(5), 0, False), (1, at(8), 2, False)]  # a replay, and the gap since the last run
    assert flags(stream.put((1, at(8)), (1, at(5)))) == sorted(first + again)
    out = flags(stream.put((2, at(200)), (1, at(2))))  # late: behind the watermark, dropped; both were silent meanwhile
    assert [f for f in out if f[3]] in ([(1, at(8), 0, True)], [(1, at(8), 0, True), (2, at(2), 0, True)])
    out = flags(stream.put((1, at(201))))
    assert (1, at(201), 0, False) in out and not any(f[1] == at(2) and f[0] == 1 for f in out)  # its state is gone: a first bar


def test_a_minute_waits_for_its_inputs(spark, tmp_path):
    stream = Stream(spark, tmp_path, PARTS, lambda s: candles.complete_minutes(s, ("trade", "mark", "rate")))
    rows = lambda out: sorted((r.k, r.ts, r.complete, r.missing, r.trade, r.mark, r.rate) for r in out.collect())
    out = stream.put((1, at(0), "trade", 1.0), (1, at(0), "mark", 2.0), (1, at(1), "trade", 5.0), (2, at(0), "rate", 9.0), (1, at(0), "odd", 0.0))
    assert rows(out) == []
    done = (1, at(0), True, "", 1.0, 2.0, 3.0)
    assert rows(stream.put((1, at(0), "rate", 3.0), (1, at(0), "trade", 7.0))) == [done]  # the first value counts
    assert rows(stream.put((1, at(0), "rate", 8.0), (1, at(0), "mark", 8.0), (1, at(0), "trade", 8.0))) == [done]  # replays
    stream.put((3, at(60), "trade", 1.0))
    out = rows(stream.put((1, at(0), "trade", 4.0), (3, at(61), "trade", 1.0)))  # late, and the time of the open minutes is over
    assert [r[:6] for r in out] == [done[:6], (1, at(1), False, "mark,rate", 5.0, None), (2, at(0), False, "trade,mark", None, None)]


def test_keys_that_expire(spark, tmp_path):
    import time

    stream = Stream(spark, tmp_path, TICKS, lambda s: candles.first_seen(s, "5 seconds"), once=True)  # time alone makes batches, so it never ends by itself
    rows = [(1, at(0), 1.0, 1), (1, at(1), 2.0, 2)]
    assert stream.put(*rows, *rows).count() == 2
    began = time.time()
    out = stream.put(rows[0], (2, at(0), 3.0, 3))
    assert out.count() == (3 if time.time() - began < 4 else out.count())
    time.sleep(6)
    assert stream.put(rows[1]).filter("event_id = 2").count() == 2  # its key had expired
