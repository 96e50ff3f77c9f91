"""Streams with state of their own, late rows, sessions and upserts, against results worked out by hand or in plain Python."""

import os
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fennmark.plans import queries
from fennmark.sources import typed
from fennmark.streaming import events, stateful

DAY = datetime(2024, 1, 1)
EVENT = "user_id long, event_type string, ts timestamp"


def at(hours: float) -> datetime:
    return DAY + timedelta(hours=hours)


def funnel(spark, steps, **how):
    frames = [spark.createDataFrame(rows, EVENT) for rows in steps]
    return events.run_in_steps(spark, frames, lambda s: stateful.funnel_stream(s, "view", "purchase", **how), "funnel", **queries.ROCKS)


def test_funnel_equals_plain_python_over_restarts(spark):
    """Rows in any order within a delivery, repeats, null users and times; the query ends after each delivery."""
    rng = random.Random(5)
    steps = []
    for k in range(3):
        rows = [(rng.randrange(12), rng.choice(["view", "purchase", "error"]), at(24 * k + rng.random() * 24)) for _ in range(60)]
        steps.append([*rows, rows[0], (None, "view", at(24 * k)), (3, "view", None), (4, None, at(24 * k + 1))])
    began, ended = {}, {}
    for user, kind, ts in (r for s in steps for r in s if r[0] is not None and r[2] is not None):
        if kind == "view":
            began[user] = min(began.get(user, ts), ts)
        if kind == "purchase":
            ended[user] = max(ended.get(user, ts), ts)
    rows = funnel(spark, steps, idle="30 days", delay="2 days")
    assert tuple(stateful.funnel_totals(rows).first()) == (len(began), sum(ended.get(u, DAY) > t for u, t in began.items()))
    last = {r.user_id: (r.b, r.e) for r in rows.groupBy("user_id").agg(F.min("began").alias("b"), F.max("ended").alias("e")).collect()}
    assert all(last[u] == (began.get(u), ended.get(u)) for u in last) and None not in last


def test_a_user_without_events_is_closed_and_starts_afresh(spark):
    steps = [[(1, "view", at(0)), (2, "view", at(0))], [(2, "error", at(100))], [(2, "error", at(200))], [(1, "purchase", at(210))]]
    rows = [tuple(r) for r in funnel(spark, steps, idle="1 day", delay="1 hour").collect()]
    assert rows.count((1, at(0), None, True)) == 1
    assert (1, None, at(210), False) in rows and (1, at(0), at(210), False) not in rows


def test_a_users_batch_reads_and_writes_the_state_once():
    """By a state store that counts its calls: a timer is registered for a new user only, and put off when it expires."""
    calls = []

    class Store:
        value, timers = None, set()

        def getValueState(self, *_):
            return self

        def exists(self):
            calls.append("exists")
            return self.value is not None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def clear(self):
            self.value = None

        def listTimers(self):
            calls.append("list")
            return iter(sorted(self.timers))

        def registerTimer(self, at):
            calls.append("register")
            self.timers = self.timers | {at}

        def deleteTimer(self, at):
            calls.append("delete")
            self.timers = self.timers - {at}

    class Watermark:
        now = 0

        def getCurrentWatermarkInMs(self):
            return self.now

    store, clock, funnel = Store(), Watermark(), stateful.Funnel("view", "purchase", 1000)
    funnel.init(store)
    rows = lambda ms: iter([pd.DataFrame({"event_type": ["view"], "us": [ms * 1000]})])
    list(funnel.handleInputRows((1,), rows(5), clock))
    assert calls == ["get", "update", "register"] and store.timers == {1005}
    calls.clear()
    list(funnel.handleInputRows((1,), rows(700), clock))
    assert calls == ["get", "update"]
    clock.now, store.timers = 1500, set()
    assert list(funnel.handleExpiredTimer((1,), clock, None)) == [] and store.timers == {1700}  # put off
    clock.now, store.timers = 1700, set()
    closed = list(funnel.handleExpiredTimer((1,), clock, None))
    assert len(closed) == 1 and bool(closed[0]["closed"][0]) and store.value is None and store.timers == set()


def test_funnel_of_no_rows(spark):
    assert tuple(stateful.funnel_totals(funnel(spark, [[]])).first()) == (0, 0)


@pytest.mark.parametrize(("slide", "late"), [(None, {DAY: 2}), ("12 hours", {DAY: 2, at(-12): 1, at(12): 2})])
def test_rows_behind_the_watermark_are_dropped_and_counted(spark, slide, late):
    """The second delivery begins with the watermark at 60 - 24 = 36 hours: windows that end by then are closed."""
    steps = [[at(1), at(13), at(60)], [at(2), at(14), at(30), at(61)], [at(200)], [at(230)]]
    frames = [spark.createDataFrame([(k, t) for t in s], "k long, ts timestamp") for k, s in enumerate(steps)]
    counted = events.run_in_steps(spark, frames, lambda s: events.window_counts(s, "1 day", slide), "late")
    rows = frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])
    got = {r.start: (r.events, r.late) for r in events.with_late(counted, rows, "1 day", slide).collect()}
    assert got[DAY][0] + got[DAY][1] == 4 and got[at(24)] == (1, 0) and got[at(48)] == (2, 0)
    assert {k: v[1] for k, v in got.items() if v[1]} == late


def test_sessions_go_on_over_deliveries_and_end_past_the_gap(spark):
    """Events up to the gap apart are one session, also when they come in two deliveries; a microsecond more makes two."""
    half = timedelta(minutes=30)
    steps = [[(1, at(0)), (2, at(0)), (None, at(0))], [(1, at(0) + half), (2, at(0) + half + timedelta(microseconds=1))], [(9, at(50))], [(9, at(60))]]
    frames = [spark.createDataFrame(s, "user_id long, ts timestamp") for s in steps]
    got = events.run_in_steps(spark, frames, events.session_counts, "sessions").filter("user_id < 9 or user_id is null")
    assert sorted((r.user_id or 0, r.session_start, r.events) for r in got.collect()) == [(0, at(0), 1), (1, at(0), 2), (2, at(0), 1), (2, at(0) + half + timedelta(microseconds=1), 1)]


def parts(folder: str, number: int) -> set[str]:
    path = f"{folder}/state/generation={number}"
    return {x for x in os.listdir(path) if x.startswith("part=")} if os.path.exists(path) else set()


def test_a_batch_rewrites_only_the_partitions_it_touches(spark, tmp_path):
    schema, folder = "k long, v int, x string", str(tmp_path / "state")
    state = events.KeyedState(spark, folder, spark.createDataFrame([], schema).schema, "k", ("v",), partitions=8)
    frame = lambda rows: spark.createDataFrame(rows, schema)
    state.merge(frame([(k, 1, "a") for k in range(100)]), 0)
    assert len(parts(folder, 0)) == 8
    state.merge(frame([(7, 2, "b"), (7, 2, "b"), (7, 0, "old")]), 1)
    touched = parts(folder, 1)
    assert len(touched) == 1 and len(parts(folder, 0)) == 8
    state.merge(frame([(7, 3, "c")]), 2)  # what batch 1 has replaced goes
    assert parts(folder, 2) == touched and parts(folder, 0).isdisjoint(touched) and len(parts(folder, 0)) == 7
    before = sorted(map(tuple, state.latest().collect()))
    state.merge(frame([(7, 3, "c")]), 2)  # run again, as after a failure
    assert sorted(map(tuple, state.latest().collect())) == before == sorted([(k, 1, "a") for k in range(100) if k != 7] + [(7, 3, "c")])
    state.merge(frame([]), 3)
    assert not parts(folder, 3) and state.latest().count() == 100


def test_state_of_null_keys_and_null_orders(spark, tmp_path):
    schema = "k long, v int, x string"
    state = events.KeyedState(spark, str(tmp_path / "state"), spark.createDataFrame([], schema).schema, "k", ("v", "x"))
    assert state.latest().count() == 0
    state.merge(spark.createDataFrame([(None, None, "a"), (None, 1, "b"), (1, None, None)], schema), 0)
    state.merge(spark.createDataFrame([(None, None, "z"), (1, 0, None), (1, 0, "c")], schema), 1)
    assert sorted(map(tuple, state.latest().collect()), key=str) == sorted([(None, 1, "b"), (1, 0, "c")], key=str)


def test_rows_that_do_not_fit_are_kept_apart(spark, tmp_path):
    lines = ['{"event_id": 1, "value": 2.5}', '{"event_id": "x", "value": 1}', '{"event_id": 2', "", '{"event_id": null, "value": 3, "more": [1]}', "[]"]
    spark.createDataFrame([(x, k % 2) for k, x in enumerate(lines)], "line string, p int").write.partitionBy("p").text(str(tmp_path / "in"))
    rows = typed.read_typed(spark, str(tmp_path / "in"), "json", "event_id long, value double", "p int")
    assert sorted(map(str, (r.event_id for r in typed.fitting(rows).filter("value > 0").select("event_id").collect()))) == ["1", "None"]
    bad = {r.line for r in typed.misfits(rows, "p").collect()}
    assert lines[1] in bad and lines[2] in bad and lines[0] not in bad
    assert typed.fitting(rows).select("p").filter("p = 0").count() + typed.misfits(rows, "p").filter("p = 0").count() == 3
    plan = rows.filter("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and len(rows.filter("p = 1").select("event_id", "_metadata.file_path").select("file_path").distinct().collect()) >= 1
    assert all("/p=1/" in r.file_path for r in rows.filter("p = 1").select("event_id", "_metadata.file_path").collect())
