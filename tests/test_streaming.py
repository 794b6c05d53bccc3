"""Streaming: stream == batch on closed windows, exact per-row state, restart from checkpoint (V8)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from tidemark.plans import catalog
from tidemark.session import scratch_path
from tidemark.sources import tables, views
from tidemark.streaming import processors as P
from tidemark.streaming import twins
from tidemark.streaming import blocked
from tidemark.streaming.replay import (event_time, file_stream, run_available_now, stage_time_slices, time_slices, to_ntz, watermark_drops)


def _rows(df, cols=None):
    return sorted(map(tuple, df.select(*(cols or df.columns)).collect()))


def test_processor_twins_equal_batch(spark):
    pairs = {"streaming_running_count": "running_count_by_user", "streaming_type_map": "running_type_map",
             "streaming_high_quantity": "high_quantity_counter",
             "streaming_dynamic_threshold": "dynamic_threshold_alerts"}
    for s_name, b_name in pairs.items():
        s = twins.STREAMING_QUERIES[s_name](spark, SF001)
        b = catalog.QUERIES[b_name](spark, SF001)
        assert _rows(s) == _rows(b, s.columns), s_name


def test_join_twins_equal_batch(spark):
    s = twins.streaming_interval_join(spark, SF001)
    assert _rows(s) == _rows(catalog.interval_join(spark, SF001), s.columns)


def test_window_twin_emits_every_window(spark):
    s = _rows(twins.streaming_tumbling_counts(spark, SF001))
    assert s == _rows(catalog.tumbling_type_counts(spark, SF001)) and len(s) > 0


def test_a_straggler_and_a_hot_key(spark):
    """One row a month late, one key with a third of the rows: even slices, full parallelism, exact sums."""
    base = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 3 == 0 else i % 50, base + dt.timedelta(seconds=i)) for i in range(3600)] + [(9999, 1, base + dt.timedelta(days=31))]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz").repartition(2)
    path = scratch_path(spark, "test", "straggler")
    k = stage_time_slices(df, path, ts="ts", n_slices=4)
    sizes = [spark.read.parquet(path).filter((F.col("ts") >= F.lit(a)) & (F.col("ts") < F.lit(b or dt.datetime(2100, 1, 1)))).count()
             for a, b in time_slices(df, "ts", 4)]
    assert k == spark.sparkContext.defaultParallelism and sum(sizes) == 3601 and max(sizes) - min(sizes) < 100
    stream = file_stream(spark, path, df.schema, files_per_batch=k)
    got = blocked.running_sum(spark, stream, "hot", keys=["k"], order=["ts", "id"], at="ts", value=F.lit(2**62),
                              finish=lambda r, n: r.select("id", F.col(n).cast("string").alias("n")))
    seen, want = {}, {}
    for i, key, _ in rows:
        seen[key] = seen.get(key, 0) + 2**62
        want[i] = str(seen[key])
    assert {r["id"]: r["n"] for r in got.collect()} == want


def test_late_rows_micro_batch_semantics(spark):
    """Late fixture: 3 s windows, 500 ms delay, batches {0.5,3.4} {1.0,3.6} {2.0,9.0} {20}.
    Spark applies the previous batch's watermark, so nothing is dropped here."""
    base = dt.datetime(2022, 2, 2)
    path = scratch_path(spark, "test", "late")
    for batch in ([0.5, 3.4], [1.0, 3.6], [2.0, 9.0], [20.0]):
        rows = [(base + dt.timedelta(seconds=s),) for s in batch]
        spark.createDataFrame(rows, "ts timestamp_ntz").coalesce(1).write.mode("append").parquet(path)
    st = file_stream(spark, path, tables_schema := spark.read.parquet(path).schema)
    agg = (st.withColumn("ts", event_time("ts")).withWatermark("ts", "500 milliseconds")
           .groupBy(F.window("ts", "3 seconds").alias("w")).agg(F.count(F.lit(1)).alias("n")))
    seen = {}
    out = run_available_now(spark, agg.select(to_ntz("w.start").alias("start"), "n"), "late_fixture",
                            on_done=lambda q: seen.update(dropped=watermark_drops(q)))
    got = {int((r["start"] - base).total_seconds()): r["n"] for r in out.collect()}
    assert got == {0: 3, 3: 2, 9: 1}
    assert seen["dropped"] == 0
    assert tables_schema is not None


def test_restart_from_checkpoint_gives_same_totals(spark):
    """V8: stop after half the input, restart on the same checkpoint, finish: same as one run."""
    ev = tables.events(spark, SF001, twins.EVENT_COLS)
    src = scratch_path(spark, "test", "restart_src")
    out = scratch_path(spark, "test", "restart_out")
    ckpt = out + "_checkpoint"

    def run():
        st = views.cart(file_stream(spark, src, ev.schema, files_per_batch=k))
        q = st.groupBy("user_id").transformWithStateInPandas(
            statefulProcessor=P.RunningCount(), outputStructType=P.RunningCount.SCHEMA,
            outputMode="Append", timeMode="None")
        return run_available_now(spark, q, "restart", checkpoint=ckpt, path=out)

    k = stage_time_slices(ev, src, ts="ts", n_slices=4, only=range(0, 2), files_per_slice=3)
    first = run().count()
    stage_time_slices(ev, src, ts="ts", n_slices=4, only=range(2, 4), files_per_slice=3)
    both = run()
    batch = catalog.running_count_by_user(spark, SF001)
    assert 0 < first < both.count()
    assert _rows(both) == _rows(batch, both.columns)


def test_late_rows_are_counted_when_dropped(spark):
    """A row whose window closed in an earlier micro-batch is dropped and counted."""
    base = dt.datetime(2022, 2, 2)
    path = scratch_path(spark, "test", "late2")
    for batch in ([0.5, 9.0], [20.0], [1.0]):  # 1.0 arrives after the watermark passed 3 s
        rows = [(base + dt.timedelta(seconds=s),) for s in batch]
        spark.createDataFrame(rows, "ts timestamp_ntz").coalesce(1).write.mode("append").parquet(path)
    st = file_stream(spark, path, spark.read.parquet(path).schema)
    agg = (st.withColumn("ts", event_time("ts")).withWatermark("ts", "500 milliseconds")
           .groupBy(F.window("ts", "3 seconds").alias("w")).agg(F.count(F.lit(1)).alias("n")))
    seen = {}
    out = run_available_now(spark, agg.select(to_ntz("w.start").alias("start"), "n"), "late_fixture2",
                            on_done=lambda q: seen.update(dropped=watermark_drops(q)))
    got = {int((r["start"] - base).total_seconds()): r["n"] for r in out.collect()}
    assert got[0] == 1 and seen["dropped"] == 1
