"""Stateful operators with timers of their own per key (``transformWithState`` on RocksDB state).

The session must use the RocksDB state store (:data:`ROCKSDB`). Timers run on event time: one that is due fires as soon as
the watermark passes it, whichever keys the rows that moved the watermark belong to. State is a few numbers an entity or an
observation and goes with its timer.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
DAY = 86_400_000


def _micros(v) -> int:
    return v.value // 1000


def _time(micros: int) -> datetime.datetime:
    return datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=micros)


class _Silence(StatefulProcessor):
    def __init__(self, gap_days: int):
        self.gap = gap_days * DAY

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "last long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        last, n = self.seen.get() if self.seen.exists() else (0, 0)
        for frame in rows:
            last, n = max(last, _micros(frame["captured_at"].max())), n + len(frame)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.seen.update((last, n))
        self.handle.registerTimer(-(-last // 1000) + self.gap)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        last, n = self.seen.get()
        self.seen.clear()
        yield pd.DataFrame({"entity_id": [key[0]], "silent_since": [_time(last + self.gap * 1000)], "rows": [n]})

    def close(self) -> None:
        pass


def silent_entities(df: DataFrame, gap_days: int, late: str = "1 day") -> DataFrame:
    """(entity_id, silent_since, rows): an entity without a row for ``gap_days``, once, while others go on; ``rows`` since the last such report.

    ``df(entity_id, captured_at)``. An entity that comes back begins anew.
    """
    kind = df.schema["entity_id"].dataType.simpleString()
    rows = df.select("entity_id", "captured_at").withWatermark("captured_at", late)
    return rows.groupBy("entity_id").transformWithStateInPandas(_Silence(gap_days), f"entity_id {kind}, silent_since timestamp, rows long", "append", "EventTime")


#: fixed value: observations are dealt to so many keys, whose rows are handled together; the state has an entry an observation
BUCKETS = 4096


class _Standing(StatefulProcessor):
    """A key is a bucket of observations: what has to be done for each of them is one write (and, where the bucket has state, one look)."""

    def __init__(self, keep_days: int):
        self.keep = keep_days * DAY
        self.step = max(DAY, self.keep // 8)  # a timer goes through all of a bucket's state, so there are few

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.size = handle, handle.getValueState("size", "n long")
        self.state = handle.getMapState("standing", "id string", "value double, status string, at long")

    def _expiry(self, at: int) -> int:
        return -(-at // 1000) + self.keep

    def _known(self, ids, n: int) -> dict:
        """The entries of ``ids``; a small bucket is read whole."""
        if n <= 4 * len(ids):
            wanted = set(ids)
            found = {k[0]: v for k, v in self.state.iterator() if k[0] in wanted} if n else {}
        else:
            found = {i: self.state.getValue((i,)) for i in ids if self.state.containsKey((i,))}
        return {i: tuple(v) for i, v in found.items()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        x = pd.concat(list(rows), ignore_index=True)
        x["_flip"] = x["supersedes"].notna()
        # of equally late rows a flip counts
        last = x.sort_values(["captured_at", "_flip"], kind="stable").drop_duplicates("target", keep="last")
        first = x[~x["_flip"]].sort_values(["captured_at", "value"], kind="stable").drop_duplicates("target", keep="last")
        values = {i: None if pd.isna(v) else float(v) for i, v in zip(first["target"], first["value"], strict=True)}
        n = self.size.get()[0] if self.size.exists() else 0
        now = timerValues.getCurrentWatermarkInMs()
        known, out, due = self._known(list(last["target"]), n), [], set()
        for i, t, flip, state in zip(last["target"], last["captured_at"], last["_flip"], last["status"], strict=True):
            value, status, at = known[i] if i in known and self._expiry(known[i][2]) > now else (None, None, -1)
            before, when = status, _micros(t)
            value = values.get(i, value)
            if when > at or (when == at and flip):
                status, at = state, when
            self.state.updateValue((i,), (value, status, at))
            due.add(-(-self._expiry(at) // self.step) * self.step)
            if status != before:
                out.append((i, status, value))
        self.size.update((n + len(last) - len(known),))
        for t in due:
            self.handle.registerTimer(t)
        if out:
            yield pd.DataFrame(out, columns=["observation_id", "status", "value"]).astype({"value": "float64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        now = timerValues.getCurrentWatermarkInMs()
        kept, gone = 0, []
        for k, v in self.state.iterator():
            if self._expiry(v[2]) <= now:
                gone.append(k)
            else:
                kept += 1
        for k in gone:
            self.state.removeKey(k)
        self.size.update((kept,))
        yield from ()

    def close(self) -> None:
        pass


def standing_changes(df: DataFrame, keep_days: int = 366, late: str = "1 day") -> DataFrame:
    """(observation_id, status, value) whenever an observation's status changes; ``df(observation_id, supersedes, captured_at, status, value)``.

    A row with ``supersedes`` changes the status of that observation. State counts for ``keep_days`` after the observation's last row: a
    retraction later than that finds nothing and comes with a null value. It is removed within an eighth of that time after.
    """
    rows = df.withWatermark("captured_at", late).select(F.coalesce("supersedes", "observation_id").alias("target"), "supersedes", "captured_at", "status", "value")
    keyed = rows.withColumn("bucket", F.pmod(F.xxhash64("target"), F.lit(BUCKETS)).cast("int"))
    return keyed.groupBy("bucket").transformWithStateInPandas(_Standing(keep_days), "observation_id string, status string, value double", "update", "EventTime")
