"""Each key's failures and refreshes as a state machine with timers over a stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Hours after a good walk until it is due again, days without news after which a key is forgotten, and how late rows may come.
REFRESH_HOURS, FORGET_DAYS, LATENESS = 24, 365, "1 hour"
OUT = "user_id bigint, at timestamp, event_id bigint, reason string, failures bigint"
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_US, _UTC = 1_000_000, dt.timezone.utc


def _micros(t: dt.datetime) -> int:
    d = t.astimezone(_UTC) - dt.datetime(1970, 1, 1, tzinfo=_UTC)
    return (d.days * 86_400 + d.seconds) * _US + d.microseconds


def _time(micros: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1, tzinfo=_UTC) + dt.timedelta(microseconds=micros)


def delay_hours(failures: int) -> float:
    return min(24.0, 1.5 * 2 ** min(failures, 4))


class Retries(StatefulProcessor):
    """Keeps, a key, its last good walk and the failures after it, by their own times and not by when they come. Rows give a row
    `seen` a key and batch; a timer gives `retry` when the delay after a failure is over, or `refresh` when a good walk is old."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.good = handle.getValueState("good", "at bigint, id bigint")
        self.failed = handle.getMapState("failed", "at bigint, id bigint", "n int")
        self.due = handle.getValueState("due", "at bigint, forget bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        good, failed = self.good.get() if self.good.exists() else None, {tuple(k) for k in self.failed.keys()}
        known, before = set(failed), good
        for r in rows:
            at = (_micros(r["ts"]), r["event_id"])
            if r["event_type"] == "error":
                failed.add(at)
            elif good is None or at > tuple(good):
                good = at
        failed = {f for f in failed if good is None or f > tuple(good)}
        for f in known - failed:
            self.failed.removeKey(f)
        for f in failed - known:
            self.failed.updateValue(f, (1,))
        if good != before:
            self.good.update(tuple(good))
        last = max([*failed, *([tuple(good)] if good else [])])
        hours = delay_hours(len(failed)) if failed else REFRESH_HOURS
        self.wake(last[0] // 1000 + int(hours * 3_600_000))
        yield Row(user_id=key[0], at=_time(last[0]), event_id=last[1], reason="seen", failures=len(failed))

    def wake(self, due: int) -> None:
        if self.due.exists():
            for t in tuple(self.due.get()):
                self.handle.deleteTimer(t)
        forget = due + FORGET_DAYS * 86_400_000
        self.due.update((due, forget))
        self.handle.registerTimer(due)
        self.handle.registerTimer(forget)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        due, _ = tuple(self.due.get()) if self.due.exists() else (None, None)
        if at != due:  # nothing was heard of the key for so long that it is forgotten
            for state in (self.good, self.failed, self.due):
                state.clear()
            return
        failed = [tuple(k) for k in self.failed.keys()]
        last = max(failed)[1] if failed else tuple(self.good.get())[1]
        yield Row(user_id=key[0], at=_time(due * 1000), event_id=last, reason="retry" if failed else "refresh", failures=len(failed))

    def close(self) -> None:
        pass


def run(stream: DataFrame, out: str, checkpoint: str, lateness: str = LATENESS) -> None:
    """Reads what is there of a stream (user_id, event_id, event_type, ts) and adds rows (OUT) to the files below `out`.

    Rows that come late count at their own place in time, as long as they are not older than the newest time read minus
    `lateness`, up to which timers have fired. A stopped run goes on from its checkpoint, and a batch that is run again gives
    the same rows. Rows that repeat an event count once. State is a key's good walk and the failures since.
    """
    spark = stream.sparkSession
    rows = stream.select("user_id", "event_id", "event_type", "ts").where("user_id IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", lateness).groupBy("user_id")
    name, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set(name, _PROVIDER)  # the only store that has timers
    try:
        due = rows.transformWithState(Retries(), OUT, "append", "EventTime")
        due.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
