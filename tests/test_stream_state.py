"""Streaming state: timers, connected streams, carried rows and their eviction, own sources; and the batch operators beside them."""

import datetime as dt
import os
import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import accumulate, late, sessions, state
from tidemark.operators.blocks import BLOCK_COLUMN, FANOUT, measured_blocks
from tidemark.session import scratch_path
from tidemark.streaming import blocked, line_log
from tidemark.streaming import joins as stream_joins
from tidemark.streaming import processors as P
from tidemark.streaming.replay import event_time, file_stream, landing_slices, run_available_now, stage_slices, stage_time_slices

BASE = dt.datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else BASE + dt.timedelta(seconds=seconds)


def landed(spark, batches, ddl, name):
    """A stream with one micro-batch for each list of rows."""
    path = scratch_path(spark, "test", name)
    for rows in batches:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)
    return file_stream(spark, path, spark.read.parquet(path).schema)


# ------------------------------------------------------------------- lists with time to live

def lists_by_hand(rows, ttl, clear_above):
    """rows: (id, key, seconds) in order; {id: items}."""
    held, written, out = {}, {}, {}
    for i, k, s in rows:
        if s is not None and written.get(k) is not None and s - written[k] >= ttl:
            held[k] = []
        held.setdefault(k, []).append(str(i))
        out[i] = ", ".join(held[k])
        if len(held[k]) > clear_above:
            held[k] = []
        written[k] = s if s is not None else written.get(k)
    return out


def random_rows(seed, n=120):
    r, now, rows = random.Random(seed), 0, []
    for i in range(n):
        now += r.choice([0, 1, 5, 9, 10, 11, 40])
        rows.append((i, r.choice([None, 1, 1, 1, 2]), None if i < 9 else now))
    return rows


@pytest.mark.parametrize("block_rows", [5, 1000])
@pytest.mark.parametrize("clear_above", [0, 2, 10])
def test_batch_lists_with_time_to_live(spark, block_rows, clear_above):
    rows = random_rows(clear_above)
    df = spark.createDataFrame([(i, k, at(s)) for i, k, s in rows], "id long, k long, ts timestamp_ntz").repartition(3)
    cut, block = measured_blocks(df, keys=["k"], at="ts", tie="id", rows=block_rows)
    got = state.recent_list_ttl(cut, key="k", ts="ts", order=["ts", "id"], block=block, fanout=FANOUT, item=F.col("id").cast("string"), ttl_us=10_000_000, clear_above=clear_above)
    assert {r["id"]: r["items"] for r in got.collect()} == lists_by_hand(rows, 10, clear_above)


@pytest.mark.parametrize("cuts", [(30, 60, 90), (1, 2, 119), (60,)])
def test_carried_lists_do_not_depend_on_micro_batches(spark, cuts):
    rows = random_rows(7)
    ends = [0, *cuts, len(rows)]
    stream = landed(spark, [[(i, k, at(s)) for i, k, s in rows[a:b]] for a, b in zip(ends, ends[1:], strict=False)], "id long, k long, ts timestamp_ntz", "lists")
    for ttl, want in ((10_000_000, lists_by_hand(rows, 10, 3)), (None, lists_by_hand(rows, 10**9, 3))):
        got = blocked.recent_lists(spark, stream, "lists", key="k", order=["ts", "id"], item=F.col("id").cast("string"), clear_above=3, ttl_us=ttl,
                                   finish=lambda r: r.select("id", "items"))
        assert {r["id"]: r["items"] for r in got.collect()} == want


def test_timers_free_expired_lists(spark):
    """A key that stays away has no state left; one that comes back after that begins a new list."""
    batches = [[(0, 1, at(0)), (1, 2, at(1)), (6, 3, None), (7, None, at(1))], [(2, 2, at(100))], [(3, 2, at(200))], [(4, 1, at(300)), (5, 2, at(300)), (8, 3, None), (9, None, at(300))]]
    stream = landed(spark, batches, "event_id long, user_id long, time timestamp_ntz", "timers").withColumn("time", event_time("time")).withWatermark("time", "0 seconds")
    out = stream.groupBy("user_id").transformWithStateInPandas(statefulProcessor=P.RecentList(ttl_us=150_000_000), outputStructType=P.RecentList.SCHEMA, outputMode="Append", timeMode="EventTime")
    seen = []
    got = run_available_now(spark, out, "timers", on_done=lambda q: seen.extend(sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress))
    assert {r["event_id"]: r["items"] for r in got.collect()} == {0: "0", 1: "1", 2: "1, 2", 3: "1, 2, 3", 4: "4", 5: "1, 2, 3, 5", 6: "6", 7: "7", 8: "6, 8", 9: "9"}
    assert seen


# ------------------------------------------------------------------- processors by hand

class Held:
    """What a processor keeps, in plain Python."""

    def __init__(self):
        self.values, self.timers, self.rows = {}, set(), []

    def getValueState(self, name, schema):  # noqa: N802
        values = self.values
        return type("V", (), {"get": lambda _: values.get(name), "update": lambda _, v: values.__setitem__(name, v), "clear": lambda _: values.pop(name, None)})()

    def getListState(self, name, schema):  # noqa: N802
        values = self.values
        return type("L", (), {"get": lambda _: iter(values.get(name, [])), "put": lambda _, v: values.__setitem__(name, list(v)), "clear": lambda _: values.pop(name, None),
                              "appendList": lambda _, v: values.setdefault(name, []).extend(v)})()

    def getMapState(self, name, key, value):  # noqa: N802
        held = self.values.setdefault(name, {})
        return type("M", (), {"iterator": lambda _: iter(list(held.items())), "updateValue": lambda _, k, v: held.__setitem__(k, v), "removeKey": lambda _, k: held.pop(k)})()

    def registerTimer(self, ms):  # noqa: N802
        self.timers.add(ms)

    def deleteTimer(self, ms):  # noqa: N802
        self.timers.discard(ms)

    def listTimers(self):  # noqa: N802
        return iter(sorted(self.timers))


def run_rows(processor, key, frame, watermark_ms=0):
    clock = type("T", (), {"getCurrentWatermarkInMs": lambda _: watermark_ms})()
    return pd.concat([*processor.handleInputRows(key, iter([frame]), clock), pd.DataFrame()], ignore_index=True)


def test_processors_take_null_ids_types_and_times():
    frame = pd.DataFrame({"event_id": [12.0, None, 3.0], "time": [pd.Timestamp(at(5)), pd.NaT, pd.Timestamp(at(1))], "event_type": ["b", None, None]})
    p = P.TypeCountMap()
    p.init(Held())
    assert run_rows(p, (None,), frame)["counts"].tolist() == ["", "", "b=1"]
    p = P.RecentList(clear_above=10)
    p.init(Held())
    got = run_rows(p, (1,), frame)
    assert got["items"].tolist() == ["", "3", "3, 12"] and got["list_size"].tolist() == [1, 2, 3] and got["event_id"].isna().tolist() == [True, False, False]
    p = P.RunningCount()
    p.init(Held())
    assert run_rows(p, (None,), frame)["n"].tolist() == [1, 2, 3]


def test_control_rows_and_data_rows_wait_for_each_other():
    held, p = Held(), P.AsOfControl(default=0)
    p.init(held)
    ms = lambda s: int(pd.Timestamp(at(s)).value // 10**6)

    def frame(rows):
        return pd.DataFrame([(k, pd.Timestamp(at(s)) if s is not None else pd.NaT, v, e, e) for k, s, v, e in rows], columns=["kind", "time", "value", "event_id", "user_id"])

    first = run_rows(p, (0,), frame([(1, 5, 3, 1), (1, 20, 3, 2), (1, None, 1, 3), (1, 7, None, 4), (0, 10, 2, None)]))
    assert first["event_id"].tolist() == [3] and first["threshold"].tolist() == [0]  # no time: at once, against the default
    second = run_rows(p, (0,), frame([(0, 6, 5, None), (0, 15, None, None)]), watermark_ms=ms(11))
    assert second[["event_id", "threshold"]].values.tolist() == [[1, 0]]
    assert [w[1] for w in held.values["waiting"]] == [2] and sorted(held.values["control"]) == [(ms(10) * 1000,)]  # what no later row meets is gone
    third = run_rows(p, (0,), frame([]), watermark_ms=ms(21))
    assert third[["event_id", "threshold"]].values.tolist() == [[2, 2]] and "waiting" not in held.values


# ------------------------------------------------------------------- carried rows

def test_closed_windows_leave_the_totals(spark):
    """Ten micro-batches of a window each: the base written after the eighth holds no closed window, late rows are left out."""
    batches = [[(w * 10 + i, at(w * 60 + i), at(w * 60), at((w + 1) * 60)) for i in range(3)] for w in range(10)]
    batches[5].append((999, at(1), at(0), at(60)))  # its window closed long before
    stream, path = landed(spark, batches, "id long, ts timestamp_ntz, ws timestamp_ntz, we timestamp_ntz", "evict"), scratch_path(spark, "test", "evicted")
    got = blocked.running_sum(spark, stream, "evict", keys=["ws", "we"], order=["ts", "id"], at="ts", value=F.lit(1), closes="we", time="ts",
                              finish=lambda r, n: r.select("id", F.col(n).cast("long").alias("n")), path=path)
    want = {w * 10 + i: i + 1 for w in range(10) for i in range(3)}
    assert {r["id"]: r["n"] for r in got.collect()} == want
    base = spark.read.parquet(f"{path}_totals/base=7").collect()
    assert [r["ws"] for r in base] == [at(7 * 60)]


def test_old_folders_of_carried_rows_go_and_a_rerun_finds_its_own(spark):
    path = scratch_path(spark, "test", "carried")
    carried, seen = blocked.Carried(path, ["k"], every=2), {}
    for b in range(9):
        rows = [(b % 3, b * 10), (None, b)]
        for _ in range(2):  # each batch runs twice, as after a crash
            before = carried.before(spark, b)
            assert ({} if before is None else {r["k"]: r["v"] for r in before.collect()}) == seen
            carried.put(spark, b, spark.createDataFrame(rows, "k long, v long"))
        seen.update(dict(rows))
    kept = sorted(os.listdir(path.removeprefix("file:")))
    assert "changed=0" not in kept and "base=1" not in kept and "base=7" in kept


def test_sums_without_a_key_over_many_micro_batches(spark):
    r = random.Random(3)
    rows = [(i, None if i < 4 else at(i // 3), r.randint(-3, 9)) for i in range(100)]
    stream = landed(spark, [rows[a:a + 9] for a in range(0, 100, 9)], "id long, ts timestamp_ntz, v int", "sums")
    got = blocked.running_sums(spark, stream, "sums", keys=[], order=["ts", "id"], at="ts", values={"n": F.lit(1), "s": F.col("v")},
                               finish=lambda r: r.select("id", F.col("n").cast("long").alias("n"), F.col("s").cast("long").alias("s")))
    want, s = {}, 0
    for i, _, v in rows:
        s += v
        want[i] = (i + 1, s)
    assert {r["id"]: (r["n"], r["s"]) for r in got.collect()} == want


@pytest.mark.parametrize("delay", [0, 30])
def test_sessions_over_micro_batches_and_their_borders(spark, delay):
    """Rows out of order by up to the delay, micro-batches that end inside of sessions, a last row that closes them all."""
    r = random.Random(delay)
    times, now = [], 0
    for _ in range(150):
        now += r.choice([0, 1, 2, 3, 5, 6, 20])
        times.append(now)
    order = sorted(range(150), key=lambda i: times[i] + r.uniform(0, delay / 2))  # within half the delay
    rows = [(i, at(times[i])) for i in order] + [(1000, at(10**7))]
    stream = landed(spark, [rows[a:a + 25] for a in range(0, 151, 25)], "id long, ts timestamp_ntz", "sessions")
    got = blocked.session_windows(spark, stream, "sessions", ts="ts", gap_us=5_000_000, sums={"n": F.lit(1)}, tiebreak=["id"], delay_us=delay * 1_000_000)
    want = []
    for t in sorted(times):
        if want and t - want[-1][1] <= 5:
            want[-1] = (want[-1][0], t, want[-1][2] + 1)
        else:
            want.append((t, t, 1))
    assert sorted(tuple(x) for x in got.collect()) == [(at(a), at(b + 5), n) for a, b, n in want]


def test_sessions_by_key_over_micro_batches(spark):
    """Null keys are a key, each key's sessions go on over the border, rows without a time are one session of their key."""
    r = random.Random(4)
    rows, now = [], 0
    for i in range(160):
        now += r.choice([0, 1, 2, 7])
        rows.append((i, r.choice([None, 1, 1, 1, 2]), None if i < 6 else now))
    batches = [[(i, k, at(s)) for i, k, s in rows[a:a + 40]] for a in range(0, 160, 40)] + [[(999, 9, at(10**7))]]
    stream = landed(spark, batches, "id long, k long, ts timestamp_ntz", "keyed_sessions")
    got = blocked.session_windows(spark, stream, "keyed_sessions", ts="ts", gap_us=5_000_000, sums={"n": F.lit(1)}, tiebreak=["id"], keys=["k"])
    want = {}
    for _, k, s in sorted(rows, key=lambda x: (x[2] is not None, x[2] or 0)):
        own = want.setdefault(k, [])
        if own and (own[-1][1] is None) == (s is None) and (s is None or s - own[-1][1] <= 5):
            own[-1] = (own[-1][0], s, own[-1][2] + 1)
        else:
            own.append((s, s, 1))
    assert sorted((tuple(x) for x in got.collect()), key=str) == sorted(((k, at(a), None if b is None else at(b + 5), n) for k, own in want.items() for a, b, n in own), key=str)


@pytest.mark.parametrize("block_rows", [3, 1000])
def test_parts_of_sessions_are_merged(spark, block_rows):
    spark.conf.set("spark.tidemark.scan.blockRows", str(block_rows))
    parts = [(0, 100, 2), (1, 2, 1), (50, 60, 1), (105, 106, 1), (112, 112, 1), (300, 310, 4), (290, 305, 1), (None, None, 5), (None, None, 1)]
    df = spark.createDataFrame([(at(a), at(b), n) for a, b, n in parts], "first timestamp_ntz, last timestamp_ntz, n long")
    got = sessions.merge_sessions(df, gap_us=5_000_000, sums=["n"]).collect()
    spark.conf.unset("spark.tidemark.scan.blockRows")
    assert sorted(map(str, got)) == sorted(str(type(got[0])(first=at(a), last=at(b), n=n)) for a, b, n in [(0, 106, 5), (112, 112, 1), (290, 310, 5), (None, None, 6)])


def test_bucketed_interval_join_keeps_bounded_state_and_no_pair_twice(spark):
    """One hot user: pairs are exact, and rows that the watermark has left behind are not in the state."""
    rows = [(i, at(i * 60)) for i in range(400)]
    batches = [rows[a:a + 50] for a in range(0, 400, 50)]
    left = landed(spark, batches, "lid long, lts timestamp_ntz", "left").select(F.lit(1).alias("k"), "lid", event_time("lts").alias("lts")).withWatermark("lts", "0 seconds")
    right = landed(spark, batches, "rid long, rts timestamp_ntz", "right").select(F.lit(1).alias("rk"), "rid", event_time("rts").alias("rts")).withWatermark("rts", "0 seconds")
    joined = stream_joins.interval_join(left, right, left_key="k", right_key="rk", left_ts="lts", right_ts="rts", span_us=600_000_000,
                                        within="rts > lts - INTERVAL 10 MINUTES AND rts < lts + INTERVAL 10 MINUTES")
    state_rows = []
    got = run_available_now(spark, joined.select("lid", "rid"), "interval", on_done=lambda q: state_rows.extend(sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress))
    assert sorted(map(tuple, got.collect())) == sorted((i, j) for i in range(400) for j in range(max(0, i - 9), min(400, i + 10)))
    assert 0 < state_rows[-1] < 150 and max(state_rows) < 400  # of 400 left rows, most in two buckets, and 400 right ones


# ------------------------------------------------------------------- slices

def test_rows_without_a_time_land_first(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else at(i)) for i in range(200)], "id long, ts timestamp_ntz").repartition(2)
    path = scratch_path(spark, "test", "timeless")
    assert landing_slices(df, "ts", 4)[0][0] is None
    k = stage_time_slices(df, path, ts="ts", n_slices=4)
    first = sorted(os.scandir(path.removeprefix("file:")), key=lambda f: f.stat().st_mtime_ns)
    files = [f.path for f in first if f.name.endswith(".parquet")]
    assert len(files) == 4 * k and spark.read.parquet(*files[:k]).filter("ts IS NULL").count() == 50
    none = df.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert landing_slices(none, "ts", 4) == [(None, None)] and landing_slices(df.filter("false"), "ts", 4) == []


def test_slices_by_an_index(spark):
    df = spark.createDataFrame([(i,) for i in range(60)], "id long")
    path = scratch_path(spark, "test", "indexed")
    k = stage_slices(df, path, F.col("id") % 3, 3)
    assert spark.read.parquet(path).count() == 60 and k >= 1


# ------------------------------------------------------------------- blocks

@pytest.mark.parametrize("times", ["none", "one", "bursts"])
def test_rows_at_one_instant_or_without_a_time_are_cut_by_the_tie(spark, times):
    r = random.Random(5)
    moment = {"none": lambda i: None, "one": lambda i: 7, "bursts": lambda i: r.choice([None, None, 3, 3, 3, 8, 8, i])}[times]
    rows = [(i, 1 if i % 5 else 2, at(moment(i))) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz")
    cut, block = measured_blocks(df, keys=["k"], at="ts", tie="id", rows=10)
    held = cut.groupBy("k", block).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    assert held <= 60
    got = state.running_count(cut, key="k", order=["ts", "id"], block=block, fanout=FANOUT)
    seen, want = {}, {}
    for i, k, t in sorted(rows, key=lambda x: (x[2] is not None, x[2] or BASE, x[0])):
        seen[k] = seen.get(k, 0) + 1
        want[i] = seen[k]
    assert {x["id"]: x["n"] for x in got.collect()} == want and BLOCK_COLUMN in cut.columns
    by_key = sessions.session_windows(cut, ts="ts", gap_us=10**9, keys=["k"], block=block, aggs=[F.count(F.lit(1)).alias("n")], tiebreak=["id"], fanout=FANOUT)
    assert sorted((x["k"], x["session_start"] is None) for x in by_key.collect()) == sorted({(k, t is None) for _, k, t in rows})


# ------------------------------------------------------------------- periodic watermark

def test_watermark_moves_at_ticks_only(spark):
    """Windows of 10 s, no delay: a row whose window ends at the last tick's maximum is late, whatever came since."""
    arrivals = [(0, 0, 5), (1, 0, 30), (2, 0, 1), (3, 1, 19), (4, 1, 20), (5, 1, 39), (6, 1, 29), (7, 2, 29), (8, 2, 30), (9, None, 0), (10, 3, None)]
    df = spark.createDataFrame([(i, t, at(s)) for i, t, s in arrivals], "id long, tick long, ts timestamp_ntz")
    got = {r["id"]: (r["is_late"], r["watermark"]) for r in late.with_periodic_watermark(df, ts="ts", tick=F.col("tick"), window_us=10_000_000, delay_us=0).collect()}
    # tick 0 runs on the rows without a tick (0 s), tick 1 on 30 s, tick 2 on 39 s
    assert {i for i, (is_late, _) in got.items() if is_late} == {3, 4, 6, 7} and got[2] == (False, at(0)) and got[9] == (False, None)
    assert got[5] == (False, at(30)) and got[8] == (False, at(39)) and got[10] == (False, at(39))


# ------------------------------------------------------------------- accumulators

def test_own_accumulator_equals_a_count_by_hand(spark):
    r = random.Random(9)
    rows = [(r.choice([None, "a", "a", "a", "b"]), r.choice([None, 1, 2]), r.choice([None, *range(20)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, g int, v long").repartition(7)
    got = accumulate.accumulate(df, keys=["k", "g"], values=["v"], accumulator=accumulate.TopCounts(3), result="top array<long>, counts array<long>").collect()
    want = {}
    for k, g, v in rows:
        held = want.setdefault((k, g), {})
        if v is not None:
            held[v] = held.get(v, 0) + 1
    assert {(x["k"], x["g"]): list(zip(x["top"], x["counts"], strict=True)) for x in got} == {k: sorted(h.items(), reverse=True)[:3] for k, h in want.items()}
    assert accumulate.accumulate(df.filter("false"), keys=["k"], values=["v"], accumulator=accumulate.TopCounts(3), result="top array<long>, counts array<long>").count() == 0


class Concat(accumulate.Accumulator):
    """Keeps every value: shows that nothing is lost or taken twice when tasks give out early."""

    def create(self):
        return []

    def add(self, held, rows):
        return held + rows.column(0).to_pylist()

    def merge(self, a, b):
        return sorted(a + b)

    def result(self, held):
        return (held,)


def test_tasks_that_give_out_early_lose_nothing(spark, monkeypatch):
    fold = accumulate._fold(Concat())
    monkeypatch.setattr(accumulate, "HELD_KEYS", 2)
    monkeypatch.setattr(accumulate.TaskContext, "get", staticmethod(lambda: type("C", (), {"partitionId": lambda _: 4})()))
    batches = [pa.RecordBatch.from_pydict({"_key": [f"k{(i + j) % 5}" for j in range(4)], "v": list(range(i, i + 4))}) for i in range(0, 40, 4)]
    found = {}
    for out in fold(iter(batches)):
        for k, task, data in zip(*[c.to_pylist() for c in out.columns], strict=True):
            assert task == 4
            found.setdefault(k, []).extend(Concat().load(data))
    assert sorted(sum(found.values(), [])) == list(range(40))


# ------------------------------------------------------------------- own source and sink

@pytest.mark.parametrize("split", [1, 2, 3, 7, 1000])
def test_stretches_of_a_file_hold_each_line_once(tmp_path, split, monkeypatch):
    monkeypatch.setattr(line_log, "READ_BYTES", 4)
    lines = ["", "a", "two words", "é漢", "", "x" * 30, "last without end"]
    (tmp_path / "f.txt").write_text("\n".join(lines), encoding="utf-8")
    (tmp_path / "g.txt").write_text("b\n\n", encoding="utf-8")
    (tmp_path / "_hidden").write_text("no\n")
    reader = line_log.LineReader({"path": str(tmp_path), "splitBytes": str(split)})
    assert reader.latestOffset() == {"last": "g.txt"}
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    got = [x for p in parts for b in reader.read(p) for x in b.column(0).to_pylist()]
    assert got == [*lines, "b", ""]
    assert [p.name for p in reader.partitions({"last": "f.txt"}, {"last": "g.txt"})] == ["g.txt"] * -(-3 // split)


def test_sink_commits_aborts_and_replaces(tmp_path):
    writer = line_log.LineWriter({"path": str(tmp_path)})
    batch = lambda *x: iter([pa.RecordBatch.from_pydict({"line": pa.array(list(x), pa.string())})])
    staged = [writer.write(batch("a", None)), writer.write(batch()), writer.write(batch("b"))]
    writer.commit(staged, 3)
    again = [writer.write(batch("c"))]
    writer.commit(again, 3)  # the micro-batch ran again
    lost = [writer.write(batch("d")), None]
    writer.abort(lost, 4)
    files = sorted(p.relative_to(tmp_path).as_posix() for p in tmp_path.rglob("*") if p.is_file())
    assert files == ["batch=000000003/part-00000.txt"] and (tmp_path / files[0]).read_text() == "c\n"
