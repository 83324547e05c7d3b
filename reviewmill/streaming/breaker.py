"""Circuit breaker as keyed state with timers.

Five failures open a breaker; a cooldown that doubles with each trip half-opens it; one trial then decides. What a key has
tripped is remembered over successes, so that the next cooldown is longer. A trial in flight
blocks other requests until its result comes.

``breaker`` needs Spark's RocksDB state store (``state_store(spark)`` sets it).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FAILURES = 5
COOLDOWN_MS, MOST_MS = 15 * 60_000, 6 * 3_600_000
STATE = "state string, failures int, trips int, retry_at long, trial boolean"
OUTPUT = "key string, at_ms long, event string, admitted boolean, state string, trips int"


def state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@dataclass(frozen=True)
class Breaker:
    state: str = "closed"
    failures: int = 0
    trips: int = 0
    retry_at: int = 0
    trial: bool = False

    def admit(self, at: int) -> tuple[Breaker, bool]:
        """A request at that time: the breaker after it, and whether it may go out."""
        if self.state == "closed":
            return self, True
        if self.trial or at < self.retry_at:
            return self, False
        return replace(self, state="half_open", trial=True), True

    def result(self, at: int, ok: bool) -> Breaker:
        if ok:
            return Breaker(trips=self.trips)
        if self.state != "half_open" and self.failures + 1 < FAILURES:
            return replace(self, failures=self.failures + 1)
        trips = self.trips + 1
        return Breaker("open", 0, trips, at + cooldown(trips))

    def cooled(self) -> Breaker:
        """After its timer."""
        return replace(self, state="half_open") if self.state == "open" else self


def cooldown(trips: int) -> int:
    return min(COOLDOWN_MS * 2 ** max(0, trips - 1), MOST_MS)


class _Processor(StatefulProcessor):
    def __init__(self, ttl_ms: int | None):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("breaker", STATE, self.ttl)

    def _now(self) -> Breaker:
        return Breaker(*self.kept.get()) if self.kept.exists() else Breaker()

    def _keep(self, b: Breaker) -> None:
        self.kept.update((b.state, b.failures, b.trips, b.retry_at, b.trial))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, out = self._now(), []
        due = {now.retry_at} if now.state == "open" else set()
        for at, event in pd.concat(list(rows)).sort_values("at_ms", kind="stable")[["at_ms", "event"]].itertuples(index=False):
            admitted = None
            if event == "request":
                now, admitted = now.admit(int(at))
            else:
                now = now.result(int(at), event == "ok")
            out.append((key[0], int(at), event, admitted, now.state, now.trips))
        wanted = {now.retry_at} if now.state == "open" else set()
        for t in due - wanted:
            self.handle.deleteTimer(t)
        for t in wanted - due:
            self.handle.registerTimer(t)
        self._keep(now)
        yield pd.DataFrame(out, columns=["key", "at_ms", "event", "admitted", "state", "trips"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = self._now()
        cooled = now.cooled()
        if cooled != now:
            self._keep(cooled)
            yield pd.DataFrame([(key[0], expiredTimerInfo.getExpiryTimeInMs(), "timer", None, cooled.state, cooled.trips)], columns=["key", "at_ms", "event", "admitted", "state", "trips"])

    def close(self) -> None:
        pass


def breaker(events: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Streaming (key, at_ms, event), event being request, ok or failed: for each, whether a request is admitted (null for results) and the breaker after it; and a row with event timer for each
    breaker whose cooldown ends, at the next micro-batch, whatever the key's own traffic.

    Rows of a key are taken in order of their times within a micro-batch. Times are compared with the breaker's own, so a replayed stream
    decides as it did; only the timer follows the clock. ttl_ms: after how long without traffic a key is forgotten.
    """
    return events.select("key", "at_ms", "event").groupBy("key").transformWithStateInPandas(_Processor(ttl_ms), OUTPUT, "append", "processingTime")
