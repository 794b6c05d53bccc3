"""Property tests: blocked operators equal a brute-force answer for any block cut.

Inputs are random small tables with a deliberately hot key (half the rows), and
the block width varies so scans cross many block boundaries.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import joins, sessions, windows
from tidemark.operators.scan import Scan, scan, time_block

BASE = dt.datetime(2024, 1, 1)
SEC = 1_000_000
SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 1, 2]), st.integers(0, 60), st.integers(-5, 9)),
    min_size=1, max_size=40)


def _df(spark, rows):
    data = [(i, k, BASE + dt.timedelta(seconds=s), v) for i, (k, s, v) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, k int, ts timestamp_ntz, v int"), data


@settings(**SETTINGS)
@given(rows=rows_strategy, width=st.sampled_from([1, 3, 7, 1000]), keyed=st.booleans())
def test_scan_matches_brute_force(spark, rows, width, keyed):
    df, data = _df(spark, rows)
    keys = ["k"] if keyed else []
    out = scan(df, keys=keys, order=["ts", "id"], block=time_block("ts", width * SEC), specs={
        "cnt": Scan("count"), "s": Scan("sum", F.col("v")), "mx_prev": Scan("max", F.col("v"), inclusive=False),
        "last_pos": Scan("last", F.when(F.col("v") > 0, F.col("id")), inclusive=True)}).collect()
    got = {r["id"]: (r["cnt"], r["s"], r["mx_prev"], r["last_pos"]) for r in out}
    assert len(got) == len(data)
    for i, k, ts, v in data:
        prior = [d for d in data if (not keyed or d[1] == k) and (d[2], d[0]) <= (ts, i)]
        before = [d for d in prior if d[0] != i]
        pos = [d for d in sorted(prior, key=lambda d: (d[2], d[0])) if d[3] > 0]
        want = (len(prior), sum(d[3] for d in prior), max((d[3] for d in before), default=None),
                pos[-1][0] if pos else None)
        assert got[i] == want


@settings(**SETTINGS)
@given(rows=rows_strategy, width=st.sampled_from([2, 5, 1000]), gap=st.sampled_from([1, 3, 10]))
def test_sessions_match_brute_force(spark, rows, width, gap):
    df, data = _df(spark, rows)
    out = sessions.session_windows(df, ts="ts", gap_us=gap * SEC, keys=["k"], block=time_block("ts", width * SEC),
                                   aggs=[F.count(F.lit(1)).alias("n")], tiebreak=["id"]).collect()
    got = sorted((r["k"], r["session_start"], r["session_end"], r["n"]) for r in out)
    want = []
    for key in sorted({d[1] for d in data}):
        ts = sorted(d[2] for d in data if d[1] == key)
        start, last, n = ts[0], ts[0], 1
        for t in ts[1:]:
            if (t - last).total_seconds() > gap:
                want.append((key, start, last + dt.timedelta(seconds=gap), n))
                start, n = t, 0
            last, n = t, n + 1
        want.append((key, start, last + dt.timedelta(seconds=gap), n))
    assert got == sorted(want)
    # sessions partition the rows
    assert sum(r[3] for r in got) == len(data)


@settings(**SETTINGS)
@given(left=rows_strategy, right=rows_strategy, lo=st.integers(-6, 0), hi=st.integers(0, 6),
       inclusive=st.booleans())
def test_interval_join_matches_brute_force(spark, left, right, lo, hi, inclusive):
    ldf, ldata = _df(spark, left)
    rdf, rdata = _df(spark, right)
    l2 = ldf.select("k", F.col("id").alias("lid"), F.col("ts").alias("lts"))
    r2 = rdf.select("k", F.col("id").alias("rid"), F.col("ts").alias("rts"))
    out = joins.interval_join(l2, r2, key="k", left_ts="lts", right_ts="rts", lower_us=lo * SEC,
                              upper_us=hi * SEC, lower_inclusive=inclusive, upper_inclusive=inclusive).collect()
    got = sorted((r["lid"], r["rid"]) for r in out)
    want = []
    for li, lk, lts, _ in ldata:
        for ri, rk, rts, _ in rdata:
            d = (rts - lts).total_seconds()
            ok = (lo <= d <= hi) if inclusive else (lo < d < hi)
            if lk == rk and ok:
                want.append((li, ri))
    assert got == sorted(want)
    # symmetric under swapping sides and negating the bounds
    swapped = joins.interval_join(r2, l2, key="k", left_ts="rts", right_ts="lts", lower_us=-hi * SEC,
                                  upper_us=-lo * SEC, lower_inclusive=inclusive, upper_inclusive=inclusive)
    assert sorted((r["lid"], r["rid"]) for r in swapped.collect()) == got


maybe = lambda s: st.one_of(st.none(), s)


@settings(**SETTINGS)
@given(events=st.lists(st.tuples(maybe(st.sampled_from([0, 1])), maybe(st.integers(0, 60))), min_size=1, max_size=12),
       control=st.lists(st.tuples(maybe(st.sampled_from([0, 1])), maybe(st.integers(0, 60)), st.integers(0, 9)), max_size=8),
       keyed=st.booleans())
def test_asof_strategies_give_one_answer(spark, events, control, keyed):
    at = lambda s: None if s is None else BASE + dt.timedelta(seconds=s)
    edf = spark.createDataFrame([(i, k, at(s)) for i, (k, s) in enumerate(events)], "id long, k int, ts timestamp_ntz")
    cdf = spark.createDataFrame([(k, at(s), v, i) for i, (k, s, v) in enumerate(control)], "k int, eff timestamp_ntz, th int, seq int")
    want = {}
    for i, (k, s) in enumerate(events):
        known = [(cs, n, v) for n, (ck, cs, v) in enumerate(control) if cs is not None and s is not None and cs <= s and (not keyed or ck == k)]
        want[i] = max(known)[2] if known else None
    for how in ({"strategy": "broadcast"}, {"strategy": "scan"}, {"max_broadcast_rows": 100, "max_loop_rows": 100}, {"max_broadcast_rows": 1, "max_loop_rows": 1}):
        got = joins.asof_join(edf, cdf, left_ts="ts", right_ts="eff", values=["th"], by=["k"] if keyed else None, right_order=["seq"], block_rows=2, **how)
        assert {r["id"]: r["th"] for r in got.collect()} == want and got.count() == len(events), how


@settings(**SETTINGS)
@given(rows=rows_strategy)
def test_sliding_total_is_size_over_slide(spark, rows):
    df, data = _df(spark, rows)
    out = windows.sliding_counts(df, "ts", "6 seconds", "2 seconds")
    assert out.agg(F.sum("events")).first()[0] == 3 * len(data)


def test_union_is_additive(spark):
    a = spark.range(10).toDF("x")
    b = spark.range(5).toDF("x")
    assert joins.union_streams(a, b, a).count() == 25


def test_null_keys_are_kept_as_a_group(spark):
    rows = [(1, None, 0), (2, None, 5), (3, 1, 1), (4, None, 9)]
    df = spark.createDataFrame([(i, k, BASE + dt.timedelta(seconds=s)) for i, k, s in rows],
                               "id long, k int, ts timestamp_ntz")
    out = scan(df, keys=["k"], order=["ts", "id"], block=time_block("ts", 3 * SEC), specs={"n": Scan("count")})
    assert sorted((r["id"], r["n"]) for r in out.collect()) == [(1, 1), (2, 2), (3, 1), (4, 3)]
    ses = sessions.session_windows(df, ts="ts", gap_us=5 * SEC, keys=["k"], block=time_block("ts", 3 * SEC),
                                   aggs=[F.count(F.lit(1)).alias("n")], tiebreak=["id"]).collect()
    assert sorted((r["k"] is None, r["n"]) for r in ses) == [(False, 1), (True, 3)]  # gaps 5 s, 4 s <= 5 s


def test_null_times_are_kept(spark):
    rows = [(1, 0, None), (2, 0, 5), (3, None, None), (4, 0, None), (5, 0, 9)]
    df = spark.createDataFrame([(i, k, None if s is None else BASE + dt.timedelta(seconds=s)) for i, k, s in rows], "id long, k int, ts timestamp_ntz")
    out = scan(df, keys=["k"], order=["ts", "id"], block=time_block("ts", 3 * SEC), specs={"n": Scan("count")})
    assert {r["id"]: r["n"] for r in out.collect()} == {1: 1, 4: 2, 2: 3, 5: 4, 3: 1}
    ses = sessions.session_windows(df, ts="ts", gap_us=5 * SEC, keys=["k"], block=time_block("ts", 3 * SEC),
                                   aggs=[F.count(F.lit(1)).alias("n")], tiebreak=["id"]).collect()
    assert sorted((r["k"] is None, r["session_start"] is None, r["n"]) for r in ses) == [(False, False, 2), (False, True, 2), (True, True, 1)]


def test_a_null_key_can_be_hot(spark):
    from tidemark.operators.blocks import measured_blocks
    df = spark.createDataFrame([(i, None if i % 3 else i, BASE + dt.timedelta(minutes=i)) for i in range(90)], "id long, k int, ts timestamp_ntz")
    out, block = measured_blocks(df, keys=["k"], at="ts", rows=10)
    assert out.count() == 90
    assert out.filter("k IS NULL").select(block).distinct().count() > 5
    assert out.filter("k IS NOT NULL").select(block).distinct().count() == 1


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(maybe(st.sampled_from([0, 0, 0, 1])), maybe(st.one_of(st.integers(0, 60), st.integers(1000, 1003)))), min_size=1, max_size=60),
       size=st.sampled_from([1, 4, 1000]))
def test_measured_blocks_follow_the_order_and_change_no_result(spark, rows, size):
    from tidemark.operators.blocks import FANOUT, measured_blocks
    data = [(i, k, None if s is None else BASE + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k int, ts timestamp_ntz")
    out, block = measured_blocks(df, keys=["k"], at="ts", rows=size)
    if block is not None:
        cut = sorted((str(r["k"]), r["ts"], r["_ablk"]) for r in out.collect() if r["ts"] is not None)
        assert all(a[2] <= b[2] for a, b in zip(cut, cut[1:], strict=False) if a[0] == b[0])
    got = scan(out, keys=["k"], order=["ts", "id"], block=block, fanout=FANOUT, specs={"n": Scan("count"), "s": Scan("sum", F.col("id")), "m": Scan("max", F.col("id"), inclusive=False)})
    at = lambda r: (r[2] is not None, r[2] or BASE, r[0])
    for r in got.collect():
        me = (r["id"], r["k"], r["ts"])
        before = [d for d in data if d[1] == me[1] and at(d) <= at(me)]
        assert (r["n"], r["s"]) == (len(before), sum(d[0] for d in before))
        assert r["m"] == max((d[0] for d in before if d[0] != me[0]), default=None)
    ses = {b: sorted(map(str, sessions.session_windows(x, ts="ts", gap_us=5 * SEC, keys=["k"], block=c, fanout=FANOUT,
                                                       aggs=[F.count(F.lit(1)).alias("n")], tiebreak=["id"]).collect()))
           for b, x, c in (("cut", out, block), ("whole", df, None))}
    assert ses["cut"] == ses["whole"]
