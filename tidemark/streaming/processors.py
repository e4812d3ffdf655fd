"""Arbitrary state of streams: processors for transformWithState, with value and map state, timers and time to live."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MINUTE = 60_000
UNITS = {"second": 1000, "minute": MINUTE, "hour": 60 * MINUTE, "day": 1440 * MINUTE}


def on_rocksdb(spark: SparkSession) -> None:
    """Arbitrary state needs a store with column families; a session that names another one is left alone and will say so."""
    if "HDFSBackedStateStoreProvider" in spark.conf.get(PROVIDER):
        spark.conf.set(PROVIDER, ROCKSDB)


def milliseconds(span: str) -> int:
    """Of text such as "2 minutes"."""
    number, unit = span.split()
    return int(number) * UNITS[unit.removesuffix("s")]


class GapFlags(StatefulProcessor):
    """Value state: the latest bar of an instrument. Timer: when it has been silent for too long."""

    def __init__(self, silence_ms: int):
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ms long")

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd

        last = self.last.get()[0] if self.last.exists() else None
        for frame in rows:
            ms = np.sort(frame["ms"].to_numpy())
            reached = np.maximum.accumulate(ms if last is None else np.append(last, ms))
            before = reached[:-1] if last is not None else np.append(ms[:1], reached[:-1])
            last = int(reached[-1])
            yield pd.DataFrame({"k": key[0], "ms": ms, "gap_minutes": np.maximum((ms - before) // MINUTE - 1, 0), "silent": False})
        if last is not None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.last.update((last,))
            self.handle.registerTimer(last + self.silence_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        if self.last.exists():
            yield pd.DataFrame({"k": [key[0]], "ms": [self.last.get()[0]], "gap_minutes": [0], "silent": [True]})
            self.last.clear()

    def close(self) -> None:
        pass


class MinuteBarrier(StatefulProcessor):
    """Map state: the values of an instrument's open minutes, and which inputs each has. Timers: when a minute goes as it is."""

    def __init__(self, inputs: tuple[str, ...], wait_ms: int):
        self.inputs, self.wait_ms = inputs, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getMapState("values", "minute long, input string", "value double")
        self.have = handle.getMapState("have", "minute long", "inputs long, gone boolean")

    def _row(self, key, minute: int, have: int):
        import pandas as pd

        values, missing = {}, []
        for i, name in enumerate(self.inputs):
            if have >> i & 1:
                values[name] = [self.values.getValue((minute, name))[0]]
                self.values.removeKey((minute, name))
            else:
                values[name] = [None]
                missing.append(name)
        return pd.DataFrame({"k": [key[0]], "minute": [minute], "complete": [not missing], "missing": [",".join(missing)], **{n: pd.Series(v, dtype="float64") for n, v in values.items()}})

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        for frame in rows:
            fresh = frame.sort_values(["minute", "input", "ts"]).drop_duplicates(["minute", "input"])
            for minute, part in fresh.groupby("minute"):
                minute = int(minute)
                if not self.have.containsKey((minute,)):
                    self.handle.registerTimer(minute + MINUTE + self.wait_ms)
                    have, gone = 0, False
                else:
                    have, gone = self.have.getValue((minute,))
                for name, value in zip(part["input"], part["value"]):
                    bit = 1 << self.inputs.index(name)
                    if not gone and not have & bit:
                        self.values.updateValue((minute, name), (value,))
                        have |= bit
                if not gone and have == (1 << len(self.inputs)) - 1:
                    yield self._row(key, minute, have)
                    gone = True
                self.have.updateValue((minute,), (have, gone))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        minute = expiredTimerInfo.getExpiryTimeInMs() - MINUTE - self.wait_ms
        if self.have.containsKey((minute,)):
            have, gone = self.have.getValue((minute,))
            if not gone:
                yield self._row(key, minute, have)
            self.have.removeKey((minute,))

    def close(self) -> None:
        pass


class SeenKeys(StatefulProcessor):
    """Map state with a time to live: the times of an instrument that have been seen."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "ts timestamp", "n long", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        for frame in rows:
            fresh = frame.drop_duplicates("ts")
            new = [not self.seen.containsKey((ts.to_pydatetime(),)) for ts in fresh["ts"]]
            for ts in fresh["ts"][new]:
                self.seen.updateValue((ts.to_pydatetime(),), (1,))
            yield fresh[new]

    def close(self) -> None:
        pass
