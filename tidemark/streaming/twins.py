"""Structured Streaming twins of the batch catalogue.

Each twin replays the driver's ``events`` table as time-ordered files (one
micro-batch per slice), runs the streaming form of an operator with
``trigger(availableNow=True)`` and returns its output. Tests and the oracle check stream == batch:

* windowed aggregations and session windows run in append mode behind a
  watermark; a row far in the future lands last and closes all windows of the input;
* stream-stream joins, ``transformWithState`` processors and the blocked scans per micro-batch
  (``blocked.py``) emit every result.

Rows without a time land in the first micro-batch, as they come first in the batch operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import duration_us
from ..operators import joins, state, windows
from ..operators.blocks import FANOUT, measured_blocks
from ..session import scratch_path
from ..sources import tables, views
from ..sinks import external, files
from . import blocked, line_log
from . import joins as stream_joins
from . import processors as P
from .replay import event_time, file_stream, landing_slices, line_stream, run_available_now, stage_slices, stage_time_slices, stream_session, to_ntz

DELAY = "10 minutes"
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "props"]
#: Closes every window: a row so long after the last one (it is in no result, its own window stays open).
FLUSH_AFTER = "INTERVAL 3650 DAYS"


def n_slices(spark: SparkSession) -> int:
    """Micro-batches of a replay: ``spark.tidemark.streaming.slices``; make it so many that a slice fits the cluster."""
    return int(spark.conf.get("spark.tidemark.streaming.slices", "4"))


_STAGED: dict[tuple, tuple[str, int]] = {}


def replay_events(spark: SparkSession, sf_dir: str, *, flush: bool = False) -> DataFrame:
    """The ``events`` table as a file stream of time-ordered micro-batches; with ``flush``, the closing row comes last.

    The landed files are immutable, so the twins of a session replay the same
    landing folder as long as the table's files are the same (each query keeps its own checkpoint).
    """
    ev = tables.events(spark, sf_dir, EVENT_COLS)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), n_slices(spark), *_state_of(ev))
    if key not in _STAGED:
        path = scratch_path(spark, "replay", "events")
        k = stage_time_slices(ev, f"{path}/slices", ts="ts", n_slices=n_slices(spark))
        last = ev.agg(F.max("ts").alias("ts")).filter("ts IS NOT NULL")
        flush_row = last.select(*[(F.col("ts") + F.expr(FLUSH_AFTER) if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in ev.schema])
        flush_row.coalesce(1).write.parquet(f"{path}/flush")
        _STAGED[key] = (path, k)
    path, files_per_slice = _STAGED[key]
    return file_stream(spark, f"{path}/{'*' if flush else 'slices'}", ev.schema, files_per_batch=files_per_slice)


def _state_of(df: DataFrame) -> tuple:
    """The table's files, their lengths and times: another state of the table is another replay."""
    files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return tuple(files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first())


def _windowed(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    return stream.withColumn("ts", event_time("ts")).withWatermark("ts", delay)


def _tumbling(spark: SparkSession, sf_dir: str, name: str, delay: str) -> DataFrame:
    se = views.server_events(replay_events(spark, sf_dir, flush=True))
    agg = (_windowed(se, delay).groupBy(F.window("ts", "3 hours").alias("w"))
           .agg(F.count_if(F.col("event_type") == S.PLAYER_REGISTERED).alias("registrations"),
                F.count(F.lit(1)).alias("events")))
    out = agg.select(to_ntz("w.start").alias("window_start"), to_ntz("w.end").alias("window_end"),
                     "registrations", "events")
    return run_available_now(spark, out, name)


def streaming_tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3 h tumbling registrations, event time, 10 min watermark, append mode."""
    return _tumbling(spark, sf_dir, "tumbling_counts", DELAY)


def streaming_source_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source's own time is the watermark (no delay), as its micro-batches come in order."""
    return _tumbling(spark, sf_dir, "source_watermark", "0 seconds")


def streaming_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines as a stream, those of purchases through a custom sink that writes a folder per epoch."""
    landing, target = scratch_path(spark, "replay", "lines"), scratch_path(spark, "streams", "lines")
    files.write_text(tables.events(spark, sf_dir, ["event_id", "event_type"]), landing, parallelism=4, name="Event")
    lines = line_stream(spark, landing, files_per_batch=2).filter(F.col("line").endswith(",purchase)"))
    external.foreach_batch(lines, external.line_directory_writer(target, "line"), f"{target}_checkpoint").awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").text(target).select(F.col("value").alias("line"))


def streaming_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 streaming: 3 h windows sliding by 1 h."""
    se = views.server_events(replay_events(spark, sf_dir, flush=True))
    agg = (_windowed(se).groupBy(F.window("ts", "3 hours", "1 hour").alias("w"))
           .agg(F.count_if(F.col("event_type") == S.PLAYER_REGISTERED).alias("registrations"),
                F.count(F.lit(1)).alias("events")))
    out = agg.select(to_ntz("w.start").alias("window_start"), to_ntz("w.end").alias("window_end"),
                     "registrations", "events")
    return run_available_now(spark, out, "sliding_counts")


def streaming_session_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T11 streaming: per-user session windows, 1 h gap (the key column is required)."""
    ev = replay_events(spark, sf_dir, flush=True)
    agg = (_windowed(ev).groupBy("user_id", F.session_window("ts", "1 hour").alias("w"))
           .agg(F.count(F.lit(1)).alias("events"),
                F.count_if(F.col("event_type") == "signup").alias("registrations")))
    out = agg.select("user_id", to_ntz("w.start").alias("session_start"), to_ntz("w.end").alias("session_end"),
                     "events", "registrations")
    return run_available_now(spark, out, "session_by_user")


def _join_sides(stream: DataFrame):
    adds = (views.cart_adds(stream).select("user_id", F.col("event_id").alias("cart_event_id"),
                                           event_time("time").alias("cart_time"))
            .withWatermark("cart_time", DELAY))
    cat = (views.catalog(stream).select(F.col("user_id").alias("c_user_id"),
                                        F.col("event_id").alias("catalog_event_id"),
                                        event_time("time").alias("catalog_time"))
           .withWatermark("catalog_time", DELAY))
    return adds, cat


def streaming_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 streaming: stream-stream inner join by user and time bucket, (-2 h, +2 h) exclusive, watermarks on both sides."""
    adds, cat = _join_sides(replay_events(spark, sf_dir))
    j = stream_joins.interval_join(adds, cat, left_key="user_id", right_key="c_user_id", left_ts="cart_time", right_ts="catalog_time", span_us=duration_us("2 hours"),
                                   within="catalog_time > cart_time - INTERVAL 2 HOURS AND catalog_time < cart_time + INTERVAL 2 HOURS")
    out = j.select("user_id", "cart_event_id", "catalog_event_id",
                   to_ntz("cart_time").alias("cart_time"), to_ntz("catalog_time").alias("catalog_time"))
    return run_available_now(spark, out, "interval_join")


def streaming_window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 streaming: pairs of the same user in the same 6 h tumbling event-time window."""
    adds, cat = _join_sides(replay_events(spark, sf_dir))
    a = adds.withColumn("w", F.window("cart_time", "6 hours"))
    c = cat.withColumn("cw", F.window("catalog_time", "6 hours"))
    j = a.join(c, F.expr("user_id = c_user_id AND w = cw"), "inner")
    out = j.select("user_id", to_ntz("w.start").alias("window_start"), to_ntz("w.end").alias("window_end"),
                   "cart_event_id", "catalog_event_id")
    return run_available_now(spark, out, "window_join")


def _cart_stream(spark, sf_dir):
    return views.cart(replay_events(spark, sf_dir))


def _process(spark, stream: DataFrame, key, proc, schema, name: str, time_mode: str = "None") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    out = stream.groupBy(*keys).transformWithState(
        statefulProcessor=proc, outputStructType=schema, outputMode="Append", timeMode=time_mode)
    return run_available_now(spark, out, name)


def _user_counts(spark: SparkSession, stream: DataFrame, name: str, **more) -> DataFrame:
    return blocked.running_sum(spark, stream, name, keys=["user_id"], order=["time", "event_id"], at="time", value=F.lit(1),
                               finish=lambda rows, n: rows.select("event_id", "user_id", F.col(n).cast("long").alias("n")), **more)


def streaming_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 streaming: counter per user, a blocked scan per micro-batch."""
    return _user_counts(spark, _cart_stream(spark, sf_dir), "running_count")


def streaming_initial_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7/V8: half of the cart events counted in batch, the other half by a ValueState processor that starts from those counts."""
    ev = tables.events(spark, sf_dir, EVENT_COLS)
    slices, landing = landing_slices(ev, "ts", n_slices(spark)), scratch_path(spark, "replay", "initial_state")
    first = range(max(1, len(slices) // 2))
    stage_time_slices(ev, f"{landing}/batch", ts="ts", n_slices=n_slices(spark), only=first)
    k = stage_time_slices(ev, f"{landing}/stream", ts="ts", n_slices=n_slices(spark), only=range(len(first), len(slices)))
    session = stream_session(spark)
    before = views.cart(session.read.schema(ev.schema).parquet(f"{landing}/batch")) if slices else views.cart(ev)
    rows, block = measured_blocks(before, keys=["user_id"], at="time")
    counted = state.running_count(rows, key="user_id", order=["time", "event_id"], block=block, fanout=FANOUT).select("event_id", "user_id", "n")
    if len(slices) < 2:
        return counted
    totals = before.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    stream = views.cart(session.readStream.schema(ev.schema).option("maxFilesPerTrigger", k).parquet(f"{landing}/stream"))
    out = stream.groupBy("user_id").transformWithState(statefulProcessor=P.RunningCountRows(), outputStructType=P.RunningCountRows.SCHEMA, outputMode="Append",
                                                       timeMode="None", initialState=totals.groupBy("user_id"))
    return counted.unionByName(run_available_now(spark, out, "initial_state"))


def streaming_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 streaming: counts per event type per user, over all events, a blocked scan per micro-batch."""
    events = replay_events(spark, sf_dir).select("event_id", "user_id", "event_type", F.col("ts").alias("time"))
    return blocked.type_counts(spark, events, "type_map", key="user_id", type_col="event_type", order=["time", "event_id"],
                               finish=lambda rows: rows.select("event_id", "user_id", "counts"))


def streaming_map_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 streaming by a MapState processor, over the cart events."""
    return _process(spark, _cart_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "time"), "user_id", P.TypeCountMapRows(), P.TypeCountMapRows.SCHEMA, "map_state")


_LIST = ("event_id", "user_id", "list_size", "items")


def streaming_recent_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 streaming: lists cleared above 10 elements; the open lists are carried from micro-batch to micro-batch."""
    return blocked.recent_lists(spark, _cart_stream(spark, sf_dir), "recent_list", key="user_id", order=["time", "event_id"], item=F.col("event_id").cast("string"),
                                clear_above=10, finish=lambda rows: rows.select(*_LIST))


def streaming_recent_list_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 streaming: ListState with clearing and an hour to live; event-time timers free the lists of users that stay away."""
    cart = _cart_stream(spark, sf_dir).withColumn("time", event_time("time")).withWatermark("time", DELAY)
    return _process(spark, cart.select("event_id", "user_id", "time"), "user_id", P.RecentListRows(ttl_us=duration_us("1 hour")), P.RecentListRows.SCHEMA,
                    "recent_list_ttl", time_mode="EventTime")


def streaming_recent_list_ttl_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 streaming for hot users: the same lists as a blocked scan per micro-batch; expired ones are no longer carried."""
    return blocked.recent_lists(spark, _cart_stream(spark, sf_dir), "recent_list_ttl_blocked", key="user_id", order=["time", "event_id"], item=F.col("event_id").cast("string"),
                                clear_above=10, ttl_us=duration_us("1 hour"), finish=lambda rows: rows.select(*_LIST))


#: Shares of the rows of a window, or of the data side of two connected streams, that are keys of their own.
SHARES = 16


def streaming_timer_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3 h windows given out by timers of a processor; a window is counted in shares, which are added up here."""
    se = _windowed(views.server_events(replay_events(spark, sf_dir, flush=True)))
    w = F.window("ts", "3 hours")
    keyed = se.select(to_ntz(w["start"]).alias("window_start"), to_ntz(w["end"]).alias("window_end"),
                      F.pmod(F.xxhash64("event_id"), F.lit(SHARES)).alias("share"), "event_type", "ts").filter("window_start IS NOT NULL")
    out = keyed.groupBy("window_start", "window_end", "share").transformWithStateInPandas(
        statefulProcessor=P.WindowTimer(S.PLAYER_REGISTERED), outputStructType=P.WindowTimer.SCHEMA, outputMode="Append", timeMode="EventTime")
    fired = run_available_now(spark, out, "timer_windows")
    return fired.groupBy("window_start", "window_end").agg(F.sum("registrations").alias("registrations"), F.sum("events").alias("events"))


def streaming_session_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T11 streaming without a key: 5 min sessions of the whole stream, the open one carried over the border of micro-batches."""
    return blocked.session_windows(spark, replay_events(spark, sf_dir, flush=True), "session_all", ts="ts", gap_us=duration_us("5 minutes"), tiebreak=["event_id"],
                                sums={"events": F.lit(1), "registrations": F.coalesce((F.col("event_type") == "signup").cast("int"), F.lit(0))})


def streaming_session_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T11 streaming for hot users: 1 h sessions by user as a blocked pass per micro-batch, open sessions carried."""
    return blocked.session_windows(spark, replay_events(spark, sf_dir, flush=True), "session_blocked", keys=["user_id"], ts="ts", gap_us=duration_us("1 hour"), tiebreak=["event_id"],
                                   sums={"events": F.lit(1), "registrations": F.coalesce((F.col("event_type") == "signup").cast("int"), F.lit(0))})


def streaming_running_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 streaming: share of purchases among purchases and views so far; two totals without a key are carried."""
    ev = replay_events(spark, sf_dir).select("event_id", "ts", "event_type")
    source = F.when(F.col("event_type") == "purchase", 0).otherwise(1)
    tagged = ev.filter(F.col("event_type").isin("purchase", "view")).select("event_id", "ts", source.alias("source"))
    ratio = F.round(F.col("first").cast("long") * 100.0 / (F.col("first") + F.col("second")).cast("long"), 6)
    return blocked.running_sums(spark, tagged, "running_ratio", keys=[], order=["ts", "source", "event_id"], at="ts",
                                values={"first": (F.col("source") == 0).cast("int"), "second": (F.col("source") == 1).cast("int")},
                                finish=lambda rows: rows.select("event_id", "source", ratio.alias("ratio")))


def streaming_global_every_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T12 streaming: global window, a count trigger of 10 and registrations so far."""
    se = views.server_events(replay_events(spark, sf_dir))
    registered = F.coalesce((F.col("event_type") == S.PLAYER_REGISTERED).cast("int"), F.lit(0))
    return blocked.running_sums(spark, se, "global_every_10", keys=[], order=["ts", "event_id"], at="ts", values={"seen": F.lit(1), "registrations": registered},
                                finish=lambda rows: rows.filter(F.col("seen") % 10 == 0).select(F.col("seen").cast("long").alias("seen"), F.col("registrations").cast("long").alias("registrations")))


def streaming_high_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 streaming: per-user counter of add-to-cart with quantity > 5, a blocked scan per micro-batch."""
    hits = _cart_stream(spark, sf_dir).filter((F.col("event_type") == S.ADD_TO_CART) & (F.col("quantity") > 5))
    return blocked.running_sum(spark, hits, "high_quantity", keys=["user_id"], order=["time", "event_id"], at="time", value=F.lit(1),
                               finish=lambda rows, n: rows.select("event_id", "user_id", F.col(n).cast("long").alias("n")))


def streaming_dynamic_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5/V6 streaming: each micro-batch is joined as of the control rows that have landed by then."""
    adds = views.cart_adds(replay_events(spark, sf_dir))
    control, out = scratch_path(spark, "replay", "thresholds"), scratch_path(spark, "streams", "dynamic_threshold")
    views.thresholds(spark).coalesce(1).write.parquet(control)

    def alerts(rows: DataFrame) -> DataFrame:
        landed = rows.sparkSession.read.schema(S.THRESHOLDS).parquet(control)
        j = joins.asof_join(rows, landed, left_ts="time", right_ts="effective_ts", values=["threshold"])
        j = j.withColumn("threshold", F.coalesce("threshold", F.lit(views.THRESHOLD_DEFAULT)))
        return j.filter(F.col("quantity") > F.col("threshold")).select("event_id", "user_id", "quantity", "threshold")

    blocked.run_batches(spark, adds, "dynamic_threshold", lambda batch, i: alerts(batch).write.mode("overwrite").parquet(f"{out}/batch={i}"))
    return blocked.read_batches(spark, out, alerts(spark.createDataFrame([], adds.schema)))


def streaming_control_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5/V6 streaming: the control rows are a stream as well, and land between the data's micro-batches.

    Data rows wait for the watermark, which is the earlier of both sides': a control side that has nothing to
    say for a while says so with a row that holds only a time, here one after each slice of the data.
    """
    ev = tables.events(spark, sf_dir, EVENT_COLS)
    landing, session = scratch_path(spark, "replay", "control_stream"), stream_session(spark)
    th, slices = views.thresholds(spark), landing_slices(ev, "ts", n_slices(spark))
    k = stage_time_slices(ev, f"{landing}/data/slices", ts="ts", n_slices=n_slices(spark))
    last = ev.agg(F.max("ts").alias("ts")).filter("ts IS NOT NULL")
    end = last.select((F.col("ts") + F.expr(FLUSH_AFTER)).alias("ts"))
    end.select(*[(F.col("ts") if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in ev.schema]).coalesce(1).write.parquet(f"{landing}/data/flush")
    for start, stop in slices:  # control files, one for each slice of the data, older ones first
        own = th.filter((F.lit(True) if start is None else F.col("effective_ts") >= F.lit(start)) & (F.lit(True) if stop is None else F.col("effective_ts") < F.lit(stop)))
        idle = (end.select("ts") if stop is None else spark.createDataFrame([(stop,)], "ts timestamp_ntz")).select(F.lit(None).cast("int").alias("threshold"), F.col("ts").alias("effective_ts"))
        own.unionByName(idle).coalesce(1).write.mode("append").parquet(f"{landing}/control")
    control = session.readStream.schema(th.schema).option("maxFilesPerTrigger", 1).parquet(f"{landing}/control") if slices else session.createDataFrame([], th.schema)
    data = session.readStream.schema(ev.schema).option("maxFilesPerTrigger", k).parquet(f"{landing}/data/*") if slices else session.createDataFrame([], ev.schema)
    if not slices:
        return spark.createDataFrame([], P.AsOfControl.SCHEMA)
    none = F.lit(None).cast("long")
    share = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share")
    c = control.select(F.lit(0).alias("kind"), event_time("effective_ts").alias("time"), F.col("threshold").alias("value"), none.alias("event_id"), none.alias("user_id"))
    c = c.withWatermark("time", "0 seconds").select("*", share)
    flushed = F.col("event_type").isNull() & F.col("event_id").isNull()  # the closing row stays, to move the watermark
    d = views.cart_adds(data.withColumn("event_type", F.when(flushed, "purchase").otherwise(F.col("event_type"))))
    d = d.select(F.lit(1).alias("kind"), event_time("time").alias("time"), F.col("quantity").alias("value"), "event_id", "user_id")
    d = d.withWatermark("time", DELAY).select("*", F.pmod(F.xxhash64("event_id"), F.lit(SHARES)).cast("int").alias("share"))
    out = c.unionByName(d).groupBy("share").transformWithStateInPandas(statefulProcessor=P.AsOfControl(views.THRESHOLD_DEFAULT), outputStructType=P.AsOfControl.SCHEMA,
                                                                       outputMode="Append", timeMode="EventTime")
    return run_available_now(spark, out, "control_stream")


def _count_trigger(spark: SparkSession, sf_dir: str, name: str, every: int, purging: bool) -> DataFrame:
    w = _cart_stream(spark, sf_dir).select(F.window("time", "1 day").alias("w"), "event_id", "time")
    w = w.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_id", "time")

    def fired(rows: DataFrame, n: str) -> DataFrame:
        rows = rows.withColumn(n, F.col(n).cast("long")).filter(F.col(n) % every == 0)
        pane = F.lit(every).cast("long") if purging else F.col(n)
        return rows.select("window_start", "window_end", (F.col(n) / every).cast("long").alias("firing"), pane.alias("pane_size"))

    return blocked.running_sum(spark, w, name, keys=["window_start", "window_end"], order=["time", "event_id"], at="time",
                               value=F.lit(1), finish=fired, closes="window_end", time="time", delay_us=duration_us(DELAY))


def streaming_count_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T13 streaming: CountTrigger(5) on 1-day windows of the cart stream (cumulative panes)."""
    return _count_trigger(spark, sf_dir, "count_trigger", 5, purging=False)


def streaming_count_trigger_purging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T14 streaming: the purging trigger, panes of exactly 5."""
    return _count_trigger(spark, sf_dir, "count_trigger_purging", 5, purging=True)


def streaming_rolling_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 streaming: keyBy(n is even).reduce(_ + _); two keys, each spread over its blocks. Sums are given as text, exact."""
    ev = replay_events(spark, sf_dir).select("event_id", (F.col("event_id") % 2 == 0).alias("is_even"))
    return blocked.running_sum(spark, ev, "rolling_reduce", keys=["is_even"], order=["event_id"], at=F.col("event_id"), value=F.col("event_id"),
                               finish=lambda rows, n: rows.select("event_id", "is_even", F.col(n).cast("string").alias("running_sum")))


def streaming_side_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 streaming: main and side output of one read of the stream, each micro-batch written to both."""
    cart, out = _cart_stream(spark, sf_dir), scratch_path(spark, "streams", "side_outputs")

    def tagged(rows: DataFrame) -> DataFrame:
        return rows.withColumn("output", F.when(F.coalesce(F.col("user_id") == 1, F.lit(False)), F.lit("side")).otherwise(F.lit("main")))

    def step(batch: DataFrame, batch_id: int) -> None:
        tagged(batch).write.mode("overwrite").partitionBy("output").parquet(f"{out}/batch={batch_id}")

    blocked.run_batches(spark, cart, "side_outputs", step)
    main, side = (blocked.read_batches(spark, f"{out}", tagged(spark.createDataFrame([], cart.schema)).drop("output")) for _ in range(2))
    place = F.col("_metadata.file_path")
    return main.filter(place.contains("/output=main/")).withColumn("output", F.lit("main")).unionByName(
        side.filter(place.contains("/output=side/")).withColumn("output", F.lit("side")))


def streaming_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8: the running count stopped after half of the input and started again from its checkpoint."""
    ev = tables.events(spark, sf_dir, EVENT_COLS)
    landing, out = scratch_path(spark, "replay", "restart"), scratch_path(spark, "streams", "restart")
    half = n_slices(spark) // 2
    result = None
    for part in (range(half), range(half, n_slices(spark))):
        k = stage_time_slices(ev, landing, ts="ts", n_slices=n_slices(spark), only=part)
        stream = views.cart(file_stream(spark, landing, ev.schema, files_per_batch=k))
        result = _user_counts(spark, stream, "restart", checkpoint=f"{out}_checkpoint", path=out)
    return result


def streaming_restart_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2/V8: the same with the ValueState processor, whose state store goes on from the checkpoint."""
    ev = tables.events(spark, sf_dir, EVENT_COLS)
    landing, out = scratch_path(spark, "replay", "restart_state"), scratch_path(spark, "streams", "restart_state")
    half = n_slices(spark) // 2
    result = None
    for part in (range(half), range(half, n_slices(spark))):
        k = stage_time_slices(ev, landing, ts="ts", n_slices=n_slices(spark), only=part)
        stream = views.cart(file_stream(spark, landing, ev.schema, files_per_batch=k))
        counted = stream.groupBy("user_id").transformWithState(
            statefulProcessor=P.RunningCountRows(), outputStructType=P.RunningCountRows.SCHEMA, outputMode="Append", timeMode="None")
        result = run_available_now(spark, counted, "restart_state", checkpoint=f"{out}_checkpoint", path=out)
    return result


def streaming_line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines from a source of our own through a sink of our own, stopped halfway and started again.

    The source's offsets name files, the sink commits a micro-batch's lines as a folder; the first run reads the lines of
    the events before the middle one, the second goes on from the checkpoint.
    """
    landing, target = scratch_path(spark, "replay", "line_log"), scratch_path(spark, "streams", "line_log")
    ev = tables.events(spark, sf_dir, ["event_id", "event_type"])
    middle = (ev.agg(F.max("event_id")).first()[0] or 0) // 2
    early = F.coalesce(F.col("event_id") <= middle, F.lit(True))
    session = stream_session(spark)
    for registering in (session, spark):  # the writer looks it up in whichever session is active
        registering.dataSource.register(line_log.LineLog)
    for part, rows in enumerate((ev.filter(early), ev.filter(~early))):
        files.write_text(rows, f"{landing}/part={part}", parallelism=4, name="Event")
        lines = session.readStream.format("line_log").option("splitBytes", 1 << 20).load(landing).filter(F.col("line").endswith(",purchase)"))
        query = lines.writeStream.format("line_log").option("path", target).option("checkpointLocation", f"{target}_checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return spark.read.option("recursiveFileLookup", "true").text(target).select(F.col("value").alias("line"))


def streaming_count_edge_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 streaming with null keys and null times: nulls are a key, and rows without a time come in the first micro-batch."""
    ev = tables.events(spark, sf_dir, ["event_id", "ts", "user_id"])
    e = F.col("event_id")
    rows = ev.select("event_id", F.when(e % 13 != 0, F.col("user_id") % 7).alias("grp"), F.when(e % 97 != 0, F.col("ts")).alias("ts"))
    landing = scratch_path(spark, "replay", "edge_cases")
    k = stage_time_slices(rows, landing, ts="ts", n_slices=n_slices(spark))
    shown = F.coalesce("grp", F.lit(-1)).cast("long").alias("grp")
    return blocked.running_sum(spark, file_stream(spark, landing, rows.schema, files_per_batch=k), "edge_cases", keys=["grp"], order=["ts", "event_id"], at="ts", value=F.lit(1),
                               finish=lambda rows, n: rows.select("event_id", shown, F.col(n).cast("long").alias("n")))


def streaming_ingest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 streaming: 1 h windows over a recorded ingest time (a few seconds after the event's)."""
    ev = replay_events(spark, sf_dir, flush=True)
    ingest = event_time("ts") + F.make_dt_interval(secs=F.pmod(F.coalesce("event_id", F.lit(0)) * 7, F.lit(20)).cast("decimal(18,6)"))
    timed = ev.select(ingest.alias("ingest_ts")).withWatermark("ingest_ts", DELAY)
    counts = windows.processing_time_counts(timed, "1 hour")
    return run_available_now(spark, counts.select(to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"), "events"), "ingest_windows")


def streaming_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 streaming: rows that arrive one or two micro-batches late, 30 min windows, a watermark of 1 h.

    Spark drops a row whose window ended before the watermark that the micro-batch before it ran with,
    which is the latest time of all rows up to two micro-batches earlier, less the delay.
    """
    ev = tables.events(spark, sf_dir, ["event_id", "ts"]).filter("ts IS NOT NULL")
    last = ev.agg(F.max("event_id")).first()[0] or 0
    late = F.when(F.col("event_id") % 40 == 0, 2).when(F.col("event_id") % 20 == 0, 1).otherwise(0)
    landing = scratch_path(spark, "replay", "late")
    k = stage_slices(ev, f"{landing}/slices", F.expr(f"event_id * 4 div {last + 1}") + late, 6)
    flush = ev.agg(F.max("ts").alias("ts")).filter("ts IS NOT NULL").select(F.lit(None).cast("long").alias("event_id"), (F.col("ts") + F.expr(FLUSH_AFTER)).alias("ts"))
    flush.coalesce(1).write.parquet(f"{landing}/flush")
    stream = file_stream(spark, f"{landing}/*", ev.schema, files_per_batch=k)
    agg = (stream.withColumn("ts", event_time("ts")).withWatermark("ts", "1 hour").groupBy(F.window("ts", "30 minutes").alias("w"))
           .agg(F.count(F.lit(1)).alias("events")))
    out = agg.select(to_ntz("w.start").alias("window_start"), to_ntz("w.end").alias("window_end"), "events")
    return run_available_now(spark, out, "late_counts")


STREAMING_QUERIES = {
    "streaming_rolling_reduce": streaming_rolling_reduce,
    "streaming_count_trigger": streaming_count_trigger,
    "streaming_tumbling_counts": streaming_tumbling_counts,
    "streaming_sliding_counts": streaming_sliding_counts,
    "streaming_session_by_user": streaming_session_by_user,
    "streaming_interval_join": streaming_interval_join,
    "streaming_window_join": streaming_window_join,
    "streaming_running_count": streaming_running_count,
    "streaming_count_edge_cases": streaming_count_edge_cases,
    "streaming_initial_state": streaming_initial_state,
    "streaming_map_state": streaming_map_state,
    "streaming_recent_list_ttl": streaming_recent_list_ttl,
    "streaming_recent_list_ttl_blocked": streaming_recent_list_ttl_blocked,
    "streaming_timer_windows": streaming_timer_windows,
    "streaming_control_stream": streaming_control_stream,
    "streaming_session_all": streaming_session_all,
    "streaming_session_blocked": streaming_session_blocked,
    "streaming_running_ratio": streaming_running_ratio,
    "streaming_global_every_10": streaming_global_every_10,
    "streaming_restart_state": streaming_restart_state,
    "streaming_line_log": streaming_line_log,
    "streaming_type_map": streaming_type_map,
    "streaming_recent_list": streaming_recent_list,
    "streaming_high_quantity": streaming_high_quantity,
    "streaming_dynamic_threshold": streaming_dynamic_threshold,
    "streaming_count_trigger_purging": streaming_count_trigger_purging,
    "streaming_side_outputs": streaming_side_outputs,
    "streaming_restart": streaming_restart,
    "streaming_ingest_windows": streaming_ingest_windows,
    "streaming_late_counts": streaming_late_counts,
    "streaming_source_watermark": streaming_source_watermark,
    "streaming_lines": streaming_lines,
}
