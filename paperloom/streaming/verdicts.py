"""Verdicts on pages as they arrive: a state for each key that stages of fixing move on, retries after errors, and states that are given up.

A key's state is what its events in order of time make of it, whatever batches they come in, as long as batches come in order. Late events, older than the last of
their key, change nothing and are reported as such."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..operators.audit import _FIXES

#: The state store that keeps values and timers.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
STATE = "status string, at long, seq long, errors int"
OUT = "key string, status string, at timestamp, seq long, errors int, action string"
FIRST = "CORRUPTED"
_TO = {(stage, verdict): to for stage, verdict, to in _FIXES}


def moved(status: str, stage: str, verdict: str) -> str:
    """What a stage's verdict makes of a status; errors and stages that say nothing leave it."""
    return _TO.get((stage, verdict), _TO.get((stage, None), status))


class _Verdicts(StatefulProcessor):
    """retry: milliseconds after which a key whose last event is an error is to be done again, and again until it is; most: retries. forget: milliseconds without an event after
    which a key's state is dropped; one that comes again begins anew."""

    def __init__(self, retry: int, forget: int, most: int):
        self.retry, self.forget, self.most = retry, forget, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("verdict", STATE)

    def _timer(self, at: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
        self.handle.registerTimer(at)

    def _row(self, key, state: tuple, action: str) -> pd.DataFrame:
        status, at, seq, errors = state
        return pd.DataFrame([(key[0], status, pd.Timestamp(at, unit="ms"), seq, errors, action)], columns=["key", "status", "at", "seq", "errors", "action"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = tuple(self.value.get()) if self.value.exists() else (FIRST, -1, -1, 0)
        late = 0
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["at", "seq"])  # a key's events of one batch
        for at, seq, stage, verdict in zip((batch["at"].astype("int64") // 1_000_000 if batch["at"].dtype.str.endswith("[ns]") else batch["at"].astype("datetime64[ms]").astype("int64")), batch["seq"], batch["stage"], batch["verdict"]):
            at, seq = int(at), int(seq)
            if (at, seq) <= (state[1], state[2]):
                late += 1
            elif verdict == "ERROR":
                state = (state[0], at, seq, state[3] + 1)
            else:
                state = (moved(state[0], stage, verdict), at, seq, 0)
        self.value.update(state)
        self._timer(state[1] + (self.retry if 0 < state[3] <= self.most else self.forget))
        yield self._row(key, state, "LATE" if late == len(batch) else "STATE")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.value.exists():
            return
        state = tuple(self.value.get())
        now = int(expiredTimerInfo.getExpiryTimeInMs())
        if 0 < state[3] <= self.most and now - state[1] < self.forget:
            state = (state[0], state[1], state[2], state[3] + 1)
            self.value.update(state)
            self.handle.registerTimer(now + self.retry if state[3] <= self.most else state[1] + self.forget)
            yield self._row(key, state, "RETRY")
        else:
            self.value.clear()
            yield self._row(key, state, "FORGOTTEN")

    def close(self) -> None:
        pass


def verdicts(events: DataFrame, late: str = "1 hour", retry: str = "10 minutes", forget: str = "30 days", most: int = 3) -> DataFrame:
    """events(key string, at timestamp, seq long, stage, verdict), a stream, as (key, status, at, seq, errors, action): STATE after each batch with events of a key, RETRY where one is
    to be done again, FORGOTTEN where its state goes, LATE where all of its events were older than what is known.

    Time is the events' own: a watermark of `late` behind the latest lets timers expire, so a replay gives what a live run gave. Null keys are one key."""
    spark = events.sparkSession
    spark.conf.set(*STORE)
    millis = lambda x: int(pd.Timedelta(x).total_seconds() * 1000)
    processor = _Verdicts(millis(retry), millis(forget), most)
    keyed = events.withWatermark("at", late).groupBy("key")
    return keyed.transformWithStateInPandas(processor, StructType.fromDDL(OUT), "Update", "eventTime")
