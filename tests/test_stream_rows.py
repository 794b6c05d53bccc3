"""Processors over rows: what they give equals what they give over frames, without a frame per key."""

import pandas as pd
import pytest
from pyspark.sql import GroupedData, Row
from pyspark.sql import functions as F

from conftest import SF001
from test_stream_state import Held, at, landed, lists_by_hand
from tidemark.streaming import processors as P
from tidemark.streaming import twins
from tidemark.streaming.replay import event_time, run_available_now

ROW = Row("event_id", "time", "event_type")
BATCHES = [[(5, 7, at(40), "b"), (1, 7, None, "a"), (None, 7, at(40), None), (2, None, at(3), "b"), (3, 8, at(2), "a")],
           [(9, 7, at(90), "a"), (8, 7, at(90), "b"), (10, None, None, "b"), (11, 8, at(500), None)],
           [(12, 7, at(700), "c"), (13, None, at(701), "a"), (14, 8, at(702), "a"), (15, 9, at(703), "é")]]


def test_type_counts_and_counts_over_rows_by_hand():
    p = P.TypeCountMapRows()
    p.init(Held())
    rows = [ROW(12, at(5), "b"), ROW(None, None, None), ROW(3, at(1), None), ROW(2, at(5), "a")]
    assert [tuple(r) for r in p.handleInputRows((None,), iter(rows), None)] == [(None, None, ""), (3, None, ""), (2, None, "a=1"), (12, None, "a=1, b=1")]
    assert [tuple(r) for r in p.handleInputRows((None,), iter([ROW(20, at(9), "b")]), None)] == [(20, None, "a=1, b=2")]
    p = P.RunningCountRows()
    p.init(Held())
    p.handleInitialState((4,), Row(user_id=4, n=3), None)
    p.handleInitialState((4,), Row(user_id=4, n=2), None)
    assert [tuple(r) for r in p.handleInputRows((4,), iter(rows), None)] == [(None, 4, 6), (3, 4, 7), (2, 4, 8), (12, 4, 9)]


@pytest.mark.parametrize("name", ["streaming_map_state", "streaming_initial_state", "streaming_restart_state"])
def test_twins_by_key_make_no_frame_per_key(spark, monkeypatch, name):
    """A frame per user and micro-batch was most of these queries' time."""
    monkeypatch.setattr(GroupedData, "transformWithStateInPandas", None)
    assert twins.STREAMING_QUERIES[name](spark, SF001).count() > 0


def test_type_counts_over_rows_equal_those_over_frames(spark):
    stream = landed(spark, BATCHES, "event_id long, user_id long, time timestamp_ntz, event_type string", "rows_types")
    got = run_available_now(spark, stream.groupBy("user_id").transformWithState(statefulProcessor=P.TypeCountMapRows(), outputStructType=P.TypeCountMap.SCHEMA, outputMode="Append", timeMode="None"), "rows_types")
    got = {r["event_id"]: (r["user_id"], r["counts"]) for r in got.collect()}
    assert got == {1: (7, "a=1"), 5: (7, "a=1, b=1"), None: (7, "a=1"), 8: (7, "a=1, b=2"), 9: (7, "a=2, b=2"), 12: (7, "a=2, b=2, c=1"), 2: (None, "b=1"), 10: (None, "b=2"),
                   13: (None, "a=1, b=2"), 3: (8, "a=1"), 11: (8, "a=1"), 14: (8, "a=2"), 15: (9, "é=1")}


# --------------------------------------------------------------------- lists with time to live

class Asked(Held):
    """Which calls go to the state store."""

    def __init__(self):
        super().__init__()
        self.calls = []

    def _noted(self, name, variable):
        calls = self.calls

        class Noted:
            def __getattr__(self, call):
                calls.append(f"{name}.{call}")
                return getattr(variable, call)
        return Noted()

    def getValueState(self, name, schema):  # noqa: N802
        return self._noted(name, super().getValueState(name, schema))

    def getListState(self, name, schema):  # noqa: N802
        return self._noted(name, super().getListState(name, schema))

    def registerTimer(self, ms):  # noqa: N802
        self.calls.append("registerTimer")
        super().registerTimer(ms)

    def deleteTimer(self, ms):  # noqa: N802
        self.calls.append("deleteTimer")
        super().deleteTimer(ms)

    def listTimers(self):  # noqa: N802
        self.calls.append("listTimers")
        return super().listTimers()


def test_lists_over_rows_ask_the_store_for_no_more_than_they_need():
    held, frames = Asked(), Asked()
    p, q = P.RecentListRows(clear_above=2, ttl_us=100_000_000), P.RecentList(clear_above=2, ttl_us=100_000_000)
    p.init(held)
    q.init(frames)
    batches = [[(0, 5), (1, 5), (2, 6)], [(3, 80)], [(4, None)], [(5, 180), (6, 181)], [(7, 181)], [(8, 400)]]
    got = {}
    want = lists_by_hand([(i, 1, s) for b in batches for i, s in sorted(b, key=lambda x: x[0])], 100, 2)
    for batch in batches:
        held.calls.clear()
        frames.calls.clear()
        for r in p.handleInputRows((1,), iter([ROW(i, at(s), None) for i, s in reversed(batch)]), None):
            got[r["event_id"]] = r["items"]
        frame = pd.DataFrame({"event_id": [i for i, _ in batch], "time": pd.to_datetime([at(s) for _, s in batch])})
        assert [x for f in q.handleInputRows((1,), iter([frame]), None) for x in f["items"]] == [want[i] for i, _ in batch]
        assert held.calls == frames.calls and len(held.calls) <= 6 and "listTimers" not in held.calls
        assert held.timers == frames.timers and len(held.timers) == 1
    assert got == want


def test_lists_over_rows_expire_and_are_freed(spark, monkeypatch):
    monkeypatch.setattr(GroupedData, "transformWithStateInPandas", None)
    assert twins.streaming_recent_list_ttl(spark, SF001).count() > 0
    stream = landed(spark, BATCHES, "event_id long, user_id long, time timestamp_ntz, event_type string", "rows_lists")
    stream = stream.withColumn("time", event_time("time")).withWatermark("time", "0 seconds").select("event_id", "user_id", "time")
    out = stream.groupBy("user_id").transformWithState(statefulProcessor=P.RecentListRows(ttl_us=300_000_000), outputStructType=P.RecentList.SCHEMA, outputMode="Append", timeMode="EventTime")
    got = run_available_now(spark, out.filter(F.col("event_id").isNotNull()), "rows_lists")
    assert {r["event_id"]: (r["user_id"], r["list_size"], r["items"]) for r in got.collect()} == {
        1: (7, 1, "1"), 5: (7, 3, "1, 5"), 8: (7, 4, "1, 5, 8"), 9: (7, 5, "1, 5, 8, 9"), 12: (7, 1, "12"), 2: (None, 1, "2"), 10: (None, 2, "2, 10"), 13: (None, 1, "13"),
        3: (8, 1, "3"), 11: (8, 1, "11"), 14: (8, 2, "11, 14"), 15: (9, 1, "15")}


# --------------------------------------------------------------------- rows without a user

@pytest.mark.parametrize("name", ["streaming_map_state", "streaming_recent_list_ttl", "streaming_initial_state", "streaming_restart_state"])
def test_rows_without_a_user_are_a_user_of_their_own(spark, tmp_path, name):
    """Over frames a null key was no key (NaN): its rows and those of the users after it met in one state."""
    rows = [(i, at(60 * i), None if i % 5 == 0 else i % 5 + 10 * (i % 3), "purchase" if i % 7 < 3 else "error") for i in range(160)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    events.withColumn("value", F.lit(1.0)).withColumn("props", F.lit('{"k": 5}')).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.tidemark.streaming.shufflePartitions", "1")
    try:
        got = {r["event_id"]: tuple(r)[1:] for r in twins.STREAMING_QUERIES[name](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.tidemark.streaming.shufflePartitions")
    lists, seen, want = lists_by_hand([(i, u, 60 * i) for i, _, u, _ in rows], 3600, 10), {}, {}
    for i, _, user, kind in rows:
        own = seen.setdefault(user, {})
        own[kind] = own.get(kind, 0) + 1
        named = {"AddToShoppingCartEvent": own.get("purchase", 0), "RemovedFromShoppingCartEvent": own.get("error", 0)}
        counts = ", ".join(f"{k}={n}" for k, n in named.items() if n)
        want[i] = (user, counts) if name == "streaming_map_state" else (user, lists[i].count(",") + 1, lists[i]) if name == "streaming_recent_list_ttl" else (user, sum(own.values()))
    assert got == want
