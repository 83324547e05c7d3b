"""Hourly and daily request budgets, enforced on a stream.

A key's grants are counted by hour and by day in map state. A count is cleared by an event-time timer once the watermark has passed its window, so
state holds only windows that can still get requests.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR_MS, DAY_MS = 3_600_000, 86_400_000


class _Processor(StatefulProcessor):
    def __init__(self, per_hour: int, per_day: int):
        self.per_hour, self.per_day = per_hour, per_day

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # A window is named by its end; an hour and a day may end together.
        self.hours = handle.getMapState("hours", "ends long", "n int")
        self.days = handle.getMapState("days", "ends long", "n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(["at_ms", "id"], kind="stable")
        counts: dict[tuple[str, int], int] = {}
        known = set(self.handle.listTimers())
        known = {t[0] if isinstance(t, tuple) else t for t in known}

        def count(name: str, states, ends: int) -> int:
            if (name, ends) not in counts:
                counts[name, ends] = states.getValue((ends,))[0] if states.containsKey((ends,)) else 0
            return counts[name, ends]

        granted = []
        for at in frame["at_ms"].tolist():
            hour, day = (at // HOUR_MS + 1) * HOUR_MS, (at // DAY_MS + 1) * DAY_MS
            ok = count("hour", self.hours, hour) < self.per_hour and count("day", self.days, day) < self.per_day
            if ok:
                counts["hour", hour] += 1
                counts["day", day] += 1
            granted.append(ok)
        for (name, ends), n in counts.items():
            if n:
                (self.hours if name == "hour" else self.days).updateValue((ends,), (n,))
                if ends not in known:
                    self.handle.registerTimer(ends)
                    known.add(ends)
        yield pd.DataFrame({"key": key[0], "id": frame["id"].tolist(), "ts": pd.to_datetime(frame["at_ms"].tolist(), unit="ms"), "granted": granted})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ends = expiredTimerInfo.getExpiryTimeInMs()
        for states in (self.hours, self.days):
            if states.containsKey((ends,)):
                states.removeKey((ends,))
        return iter([])

    def close(self) -> None:
        pass


def enforced(requests: DataFrame, per_hour: int, per_day: int, late: str = "2 hours") -> DataFrame:
    """Streaming (key string, id long, ts timestamp): whether each request is granted; one that is refused counts for nothing. Hours and days are those of UTC.

    Rows of a key are taken in order of (ts, id) within a micro-batch, micro-batches as they come; rows later than the watermark are left out. Needs the
    RocksDB state store (``breaker.state_store``).
    """
    marked = requests.select("key", "id", "ts").withWatermark("ts", late).withColumn("at_ms", F.unix_millis("ts"))
    return marked.groupBy("key").transformWithStateInPandas(_Processor(per_hour, per_day), "key string, id long, ts timestamp, granted boolean", "append", "eventTime")
