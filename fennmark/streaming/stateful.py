"""A funnel kept by state with timers: for each user the first step and the last second step, closed after a time without events."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FUNNEL = "user_id long, began timestamp, ended timestamp, closed boolean"


def _time(ms: int | None) -> datetime | None:
    return None if ms is None else datetime.fromtimestamp(ms / 1e6, UTC).replace(tzinfo=None)


class Funnel(StatefulProcessor):
    """State of a user: microseconds of the least first step and the greatest second step. Whatever the order in which events come, the two
    are the same. A user without events for `idle_ms` of event time gives a closed row, and the state goes.

    A user has one timer, which is put off when it expires and not when events come: each call into the state store costs far more than
    the work on a row, so a user's batch is one reading and one writing of the state. `due` is when the user closes, in milliseconds."""

    def __init__(self, first: str, then: str, idle_ms: int) -> None:
        self.first, self.then, self.idle_ms = first, then, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.steps = handle.getValueState("steps", "began long, ended long, last long, due long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self.steps.get()
        began, ended, last, _ = held or (None, None, None, None)
        for part in rows:
            kinds, times = part["event_type"], part["us"]
            least = lambda a, b: b if a is None else min(a, b)
            most = lambda a, b: b if a is None else max(a, b)
            if (kinds == self.first).any():
                began = least(began, int(times[kinds == self.first].min()))
            if (kinds == self.then).any():
                ended = most(ended, int(times[kinds == self.then].max()))
            last = most(last, int(times.max()))
        due = max(last // 1000 + self.idle_ms, timerValues.getCurrentWatermarkInMs() + 1)
        self.steps.update((began, ended, last, due))
        if held is None:
            self.handle.registerTimer(due)
        yield self._row(key, began, ended, False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        began, ended, _, due = self.steps.get()
        if due > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(due)
        else:
            self.steps.clear()
            yield self._row(key, began, ended, True)

    def _row(self, key: Any, began: int | None, ended: int | None, closed: bool) -> pd.DataFrame:
        return pd.DataFrame({"user_id": [key[0]], "began": pd.to_datetime([_time(began)]), "ended": pd.to_datetime([_time(ended)]), "closed": [closed]})

    def close(self) -> None:
        pass


def funnel_stream(stream: DataFrame, first: str, then: str, idle: str = "3 days", delay: str = "1 hour") -> DataFrame:
    """(user_id, began, ended, closed): a user's steps whenever they come anew, and once more when the user is closed.

    Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass). Rows without a user or a time are left out; steps that come twice change
    nothing. A closed user who comes back starts afresh, so totals take the least `began` and greatest `ended` of a user's rows."""
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    kept = stream.filter("user_id is not null and ts is not null").withWatermark("ts", delay)
    rows = kept.select("user_id", "event_type", F.unix_micros("ts").alias("us"), "ts")
    return rows.groupBy("user_id").transformWithStateInPandas(Funnel(first, then, idle_ms), FUNNEL, "Append", "EventTime")


def funnel_totals(rows: DataFrame) -> DataFrame:
    """(users_first, users_then) of the rows of funnel_stream(): those with the first step, and with the second after it."""
    users = rows.groupBy("user_id").agg(F.min("began").alias("began"), F.max("ended").alias("ended")).filter("began is not null")
    return users.agg(F.count("*").alias("users_first"), F.count_if(F.col("ended") > F.col("began")).alias("users_then"))
