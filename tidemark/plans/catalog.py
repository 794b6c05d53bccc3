"""

Each entry is ``f(spark, sf_dir) -> DataFrame`` and reads the whole tables (no id
subsets, no row caps; the one ``limit`` is the top-1 of ``busiest_window``, which
is the feature). Column names match the DuckDB oracle in ``oracle.py``.

Ordered scans cut the order of keys with more than ``spark.tidemark.scan.blockRows`` rows into blocks
(``operators/blocks.py``); arrival-ordered replays use blocks of ``spark.tidemark.scan.blockIds`` ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import duration_us, entity_id, epoch_millis
from ..operators import accumulate, joins, late, partitioning, sessions, state, transforms, windows
from ..operators.blocks import FANOUT, measured_blocks
from ..operators.scan import id_block
from ..session import scratch_path
from ..sinks import files
from ..sources import elements, tables, views

H_US = 3_600_000_000
SECOND_US = 1_000_000


def _conf_int(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(f"spark.tidemark.scan.{name}", str(default)))


def block_ids(spark: SparkSession) -> int:
    return _conf_int(spark, "blockIds", 2000)


def _blocked(df: DataFrame, keys: list[str], at, tie: str | None = "event_id") -> tuple[DataFrame, dict]:
    """Rows and the scan's arguments for blocks of the data's own measure; rows order by ``at``, then by ``tie``."""
    rows, block = measured_blocks(df, keys=keys, at=at, tie=tie)
    return rows, {"block": block, "fanout": FANOUT}


def _events(spark, sf_dir, cols=None):
    return tables.events(spark, sf_dir, cols)


# --------------------------------------------------------------------------- windows

def tumbling_type_counts(spark, sf_dir):
    """T8 + A2/A3/A4: registrations (and all events) per 3 h tumbling window."""
    se = views.server_events(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"]))
    return windows.tumbling_counts(se, "ts", "3 hours", pred=F.col("event_type") == S.PLAYER_REGISTERED,
                                   count_name="registrations")


def tumbling_by_type(spark, sf_dir):
    """Keyed (event type) 3 h tumbling window counts."""
    se = views.server_events(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"]))
    return windows.tumbling_counts(se, "ts", "3 hours", keys=["event_type"], count_name="n")


def sliding_counts(spark, sf_dir):
    """3 h windows sliding by 1 h."""
    se = views.server_events(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"]))
    return windows.sliding_counts(se, "ts", "3 hours", "1 hour",
                                  pred=F.col("event_type") == S.PLAYER_REGISTERED, count_name="registrations")


def window_value_stats(spark, sf_dir):
    """A4: mergeable accumulator (sum, count -> mean) per 3 h window, partial + final."""
    ev = _events(spark, sf_dir, ["ts", "value"])
    return windows.mergeable_aggregate(
        ev, "ts", "3 hours",
        partials={"_n": F.count(F.lit(1)), "_s": F.sum("value")},
        finish={"n": F.col("_n"), "total_value": F.round("_s", 6),
                "mean_value": F.round(F.col("_s") / F.col("_n"), 6)})


def registration_windows(spark, sf_dir):
    """(window, count) of registrations over 2 h windows sliding by 1 h."""
    se = views.server_events(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"]))
    regs = se.filter(F.col("event_type") == S.PLAYER_REGISTERED)
    return windows.window_aggregate(regs, "ts", "2 hours", [F.count(F.lit(1)).alias("registrations")],
                                    slide="1 hour")


def busiest_window(spark, sf_dir):
    """The 2 h window with the most registrations (earliest on ties)."""
    return windows.busiest_window(registration_windows(spark, sf_dir), "registrations", 1)


def _session_aggs():
    return [F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("event_type") == "signup").alias("registrations")]


def session_by_user(spark, sf_dir):
    """T11 keyed: sessions per user with a 1 h gap."""
    ev, blocks = _blocked(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"]), ["user_id"], "ts")
    return sessions.session_windows(ev, ts="ts", gap_us=H_US, keys=["user_id"], **blocks,
                                    aggs=_session_aggs(), tiebreak=["event_id"])


def session_all(spark, sf_dir):
    """T11 windowAll: sessions over the whole stream with a 5 min gap."""
    ev, blocks = _blocked(_events(spark, sf_dir, ["event_id", "ts", "event_type"]), [], "ts")
    return sessions.session_windows(ev, ts="ts", gap_us=5 * 60 * SECOND_US, keys=[], **blocks,
                                    aggs=_session_aggs(), tiebreak=["event_id"])


# --------------------------------------------------------------------------- triggers

def global_every_10(spark, sf_dir):
    """Global window + CountTrigger(10): registrations among all events so far."""
    se = views.server_events(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"]))
    se, blocks = _blocked(se, [], "ts")
    return state.global_count_trigger(se, every=10, order=["ts", "event_id"], **blocks,
                                      measure=F.col("event_type") == S.PLAYER_REGISTERED, name="registrations")


def _cart_day_windows(spark, sf_dir):
    c = views.cart(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"]))
    return windows.flatten_window(c.withColumn("window", F.window("time", "1 day")))


def count_trigger(spark, sf_dir):
    """CountTrigger(5) on 1-day windows: cumulative pane sizes 5, 10, ..."""
    c, blocks = _blocked(_cart_day_windows(spark, sf_dir), ["window_start", "window_end"], "time")
    return state.window_count_trigger(c, window_start="window_start", window_end="window_end", every=5,
                                      order=["time", "event_id"], **blocks)


def count_trigger_purging(spark, sf_dir):
    """PurgingTrigger(CountTrigger(5)): panes of exactly 5."""
    c, blocks = _blocked(_cart_day_windows(spark, sf_dir), ["window_start", "window_end"], "time")
    return state.window_count_trigger(c, window_start="window_start", window_end="window_end", every=5,
                                      order=["time", "event_id"], **blocks,
                                      purging=True)


# --------------------------------------------------------------------------- keyed state

def rolling_reduce(spark, sf_dir):
    """A1: keyBy(n is even).reduce(_ + _): running sum after every element, exact and so given as text."""
    ev = _events(spark, sf_dir, ["event_id"])
    ev, blocks = _blocked(ev.withColumn("is_even", F.col("event_id") % 2 == 0), ["is_even"], F.col("event_id"), None)
    out = state.rolling_reduce(ev, key="is_even", value="event_id", order=["event_id"], key_name="is_even", **blocks)
    return out.select("event_id", "is_even", F.col("running_sum").cast("string").alias("running_sum"))


def reduce_final(spark, sf_dir):
    """A1 finals: sum per parity key, as text."""
    ev = _events(spark, sf_dir, ["event_id"])
    out = state.reduce_final(ev, key=(F.col("event_id") % 2 == 0), value="event_id", key_name="is_even")
    return out.select("is_even", F.col("total").cast("string").alias("total"))


def _cart(spark, sf_dir):
    return views.cart(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"]))


def _cart_by_user(spark, sf_dir, pred=None):
    c = _cart(spark, sf_dir)
    return _blocked(c if pred is None else c.filter(pred), ["user_id"], "time")


def running_count_by_user(spark, sf_dir):
    """V2 ValueState: events per user so far."""
    cart, blocks = _cart_by_user(spark, sf_dir)
    out = state.running_count(cart, key="user_id", order=["time", "event_id"], **blocks)
    return out.select("event_id", "user_id", "n")


def running_type_map(spark, sf_dir):
    """V4 MapState: per-user counts per event type (any type), ``type=n`` sorted."""
    ev, blocks = _blocked(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"]), ["user_id"], "ts")
    out = state.running_type_counts(ev, key="user_id", type_col="event_type", order=["ts", "event_id"], **blocks)
    return out.select("event_id", "user_id", "counts")


def recent_list_by_user(spark, sf_dir):
    """V5 ListState, cleared when it exceeds 10 elements (sizes cycle 1..11)."""
    cart, blocks = _cart_by_user(spark, sf_dir)
    out = state.recent_list(cart, key="user_id", order=["time", "event_id"], item=F.col("event_id").cast("string"), **blocks)
    return out.select("event_id", "user_id", "list_size", "items")


def recent_list_ttl(spark, sf_dir):
    """V5 ListState with both ends of a list: cleared above 10 elements, expired after an hour without a write."""
    cart, blocks = _cart_by_user(spark, sf_dir)
    out = state.recent_list_ttl(cart, key="user_id", ts="time", order=["time", "event_id"], item=F.col("event_id").cast("string"), ttl_us=H_US, **blocks)
    return out.select("event_id", "user_id", "list_size", "items")


def recent_list_ttl_edge_cases(spark, sf_dir):
    """The same with null keys and null times, lists of up to 3 and ten minutes to live."""
    left, _ = _edge_sides(spark, sf_dir)
    rows, blocks = _blocked(left, ["grp"], "ts")
    out = state.recent_list_ttl(rows, key="grp", ts="ts", order=["ts", "event_id"], item=F.col("event_id").cast("string"), ttl_us=10 * 60 * SECOND_US, clear_above=2, **blocks)
    return out.select("event_id", _shown("grp"), "list_size", "items")


def high_quantity_counter(spark, sf_dir):
    """V7/A10: per user, number of add-to-cart events with quantity > 5 so far."""
    hits = (F.col("event_type") == S.ADD_TO_CART) & (F.col("quantity") > 5)
    cart, blocks = _cart_by_user(spark, sf_dir, hits)
    out = state.running_count(cart, key="user_id", order=["time", "event_id"], **blocks)
    return out.select("event_id", "user_id", "n")


# --------------------------------------------------------------------------- row operators

def fizzbuzz(spark, sf_dir):
    """S3 + P9 + P6: numbers 1..N (event_id + 1); keep the 'fizzbuzz' ones, project n."""
    ev = _events(spark, sf_dir, ["event_id"]).select((F.col("event_id") + 1).alias("n"))
    return transforms.fizzbuzz_labels(ev).filter(F.col("output") == "fizzbuzz").select("n")


def fizzbuzz_labels(spark, sf_dir):
    """FizzBuzzResult(n, output) for every number."""
    ev = _events(spark, sf_dir, ["event_id"]).select((F.col("event_id") + 1).alias("n"))
    return transforms.fizzbuzz_labels(ev)


def map_filter(spark, sf_dir):
    """P1 + P6 (+ P2): n * 2 for even n."""
    ev = _events(spark, sf_dir, ["event_id"]).withColumnRenamed("event_id", "n")
    return transforms.map_column(ev.filter(F.col("n") % 2 == 0), F.col("n") * 2, "doubled", keep=["n"])


def fan_out_pair(spark, sf_dir):
    """N -> [n, n + 1] with n = event_id mod 20."""
    ev = _events(spark, sf_dir, ["event_id"]).withColumn("n", F.col("event_id") % 20)
    return transforms.fan_out_pair(ev, "n", keep=["event_id"])


def fan_out_range(spark, sf_dir):
    """N -> 1 .. n-1 with n = event_id mod 20."""
    ev = _events(spark, sf_dir, ["event_id"]).withColumn("n", F.col("event_id") % 20)
    return transforms.fan_out_range(ev, "n", keep=["event_id"])


def explode_quantity(spark, sf_dir):
    """P5 + P7: every add-to-cart of quantity q becomes q single-item rows."""
    adds = views.cart_adds(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"]))
    return transforms.explode_quantity(adds, keep=["event_id", "user_id"])


def threshold_alerts(spark, sf_dir):
    """P8 + P10: add-to-cart with quantity > 2, as an alert message."""
    adds = views.cart_adds(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"]))
    hits = transforms.threshold_filter(adds, "quantity", 2)
    return hits.select("event_id", "user_id", "quantity",
                       transforms.purchase_message(F.col("user_id"), F.col("quantity"), F.col("sku"),
                                                   F.lit(2)).alias("message"))


def side_output_main(spark, sf_dir):
    """Main output — everyone's cart events but user 1's."""
    main, _ = transforms.split_stream(_cart(spark, sf_dir), F.col("user_id") == 1)
    return main


def side_output_side(spark, sf_dir):
    """Side output — user 1's cart events."""
    _, side = transforms.split_stream(_cart(spark, sf_dir), F.col("user_id") == 1)
    return side


def rich_map(spark, sf_dir):
    """A function with set-up once per partition, over Arrow batches: n * 10."""
    import pyarrow as pa

    def times(batches, factor):
        import pyarrow.compute as pc
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pc.multiply(b.column(0), factor)], names=["n", "n10"])

    ev = _events(spark, sf_dir, ["event_id"]).withColumnRenamed("event_id", "n")
    return transforms.map_batches(ev, times, "n long, n10 long", setup=lambda: 10)


def event_entities(spark, sf_dir):
    """composed ids and epoch milliseconds."""
    ev = _events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"])
    return ev.select("event_id", entity_id(F.lit("player"), "user_id", "event_type").alias("entity"), epoch_millis("ts").alias("millis"))


def text_sink_roundtrip(spark, sf_dir):
    """K2/K4: adds written as text by 4 tasks, removals appended, all lines read back."""
    cart, path = _cart(spark, sf_dir), scratch_path(spark, "sinks", "text")
    row = ["event_id", "user_id", "quantity"]
    adds = F.col("event_type") == S.ADD_TO_CART
    files.write_text(cart.filter(adds).select(*row), path, parallelism=4, name="Add")
    files.append_text(cart.filter(~adds).select(*row), path, name="Remove")
    return spark.read.text(path).select(F.col("value").alias("line"))


def person_codec_roundtrip(spark, sf_dir):
    """S8 + K8 + F4/F5: Person(name, age) -> 'name,age' UTF-8 bytes -> Person."""
    from ..sources.codecs import decode_person, encode_person
    cust = tables.read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    people = cust.select("c_custkey", F.col("c_name").alias("name"), F.col("c_nationkey").alias("age"))
    wire = encode_person(people, keep=["c_custkey"])
    back = decode_person(wire, keep=["c_custkey", F.col("value").cast("string").alias("wire")])
    return back.select("c_custkey", "wire", "name", "age")


def person_codec_quarantine(spark, sf_dir):
    """Records of customers, some without a comma, an age or a whole one: kept with their raw text."""
    from ..sources.codecs import decode_person
    cust = tables.read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    k, name, age = F.col("c_custkey"), F.col("c_name"), F.col("c_nationkey").cast("string")
    wire = (F.when(k % 11 == 0, name).when(k % 7 == 0, F.concat(name, F.lit(",x"), age)).when(k % 5 == 0, F.concat(name, F.lit(",Jr,"), age))
            .when(k % 13 == 0, F.lit(None)).otherwise(F.concat(name, F.lit(","), age)))
    back = decode_person(cust.select("c_custkey", wire.alias("value")), keep=["c_custkey"], mode="quarantine")
    return back.select("c_custkey", "name", F.col("age").cast("string").alias("age"), F.col("_corrupt").alias("corrupt"))


N_TARGETS = 8


def partition_skew(spark, sf_dir):
    """Q2/Q3: load per target partition for the hash partitioner and the
    degenerate 'last partition' partitioner, with the skew ratio."""
    return partitioning.partition_report(_cart(spark, sf_dir), N_TARGETS, {
        "hash": partitioning.hash_partitioner("user_id", N_TARGETS),
        "last": partitioning.last_partition(N_TARGETS)})


def partition_placement(spark, sf_dir):
    """Q2: rows that each partition holds after they were placed by the custom partitioner."""
    cart = _cart(spark, sf_dir)
    return partitioning.placement(partitioning.partition_custom(cart, N_TARGETS, partitioning.hash_partitioner("user_id", N_TARGETS)))


# --------------------------------------------------------------------------- joins

def union_sources(spark, sf_dir):
    """Two cart streams (sku prefixed by source) unioned, duplicates kept."""
    c = _cart(spark, sf_dir)
    a = c.filter(F.col("event_type") == S.ADD_TO_CART).withColumn("sku", F.concat(F.lit("kafka_"), "sku"))
    b = c.filter(F.col("event_type") == S.REMOVED_FROM_CART).withColumn("sku", F.concat(F.lit("files_"), "sku"))
    return joins.union_streams(a, b)


def _join_sides(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"])
    adds = views.cart_adds(ev).select("user_id", F.col("event_id").alias("cart_event_id"),
                                      F.col("time").alias("cart_time"))
    cat = views.catalog(ev).select("user_id", F.col("event_id").alias("catalog_event_id"),
                                   F.col("time").alias("catalog_time"))
    return adds, cat


def _iso(c: str):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def window_join(spark, sf_dir):
    """Cart x catalog pairs of the same user in the same 6 h window."""
    adds, cat = _join_sides(spark, sf_dir)
    j = joins.window_join(adds, cat, key="user_id", left_ts="cart_time", right_ts="catalog_time",
                          size_us=6 * H_US)
    return j.select("user_id", "window_start", "window_end", "cart_event_id", "catalog_event_id",
                    F.format_string(S.BROWSED_AND_BOUGHT, F.col("user_id").cast("string"),
                                    _iso("catalog_time"), _iso("cart_time")).alias("message"))


def _interval(spark, sf_dir, inclusive: bool):
    adds, cat = _join_sides(spark, sf_dir)
    j = joins.interval_join(adds, cat, key="user_id", left_ts="cart_time", right_ts="catalog_time",
                            lower_us=-2 * H_US, upper_us=2 * H_US,
                            lower_inclusive=inclusive, upper_inclusive=inclusive)
    return j.select("user_id", "cart_event_id", "catalog_event_id", "cart_time", "catalog_time")


def interval_join(spark, sf_dir):
    """Catalog views within (-2 h, +2 h) of an add, same user, both bounds exclusive."""
    return _interval(spark, sf_dir, False)


def interval_join_inclusive(spark, sf_dir):
    """J3 default bounds: [-2 h, +2 h]."""
    return _interval(spark, sf_dir, True)


def running_ratio(spark, sf_dir):
    """connect(purchases, views) + running percentage of purchases after every arrival."""
    ev = _events(spark, sf_dir, ["event_id", "ts", "event_type"])
    source = F.when(F.col("event_type") == "purchase", 0).otherwise(1)
    out = joins.running_ratio(ev.filter(F.col("event_type").isin("purchase", "view")).select("event_id", "ts", source.alias("source")))
    return out.select("event_id", "source", "ratio")


def dynamic_threshold_alerts(spark, sf_dir, strategy: str = "broadcast"):
    """Add-to-cart above the threshold in force at its time (0 before the first)."""
    adds = views.cart_adds(_events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"]))
    th = views.thresholds(spark)
    # The control table is a literal of len(THRESHOLD_VALUES) rows: its bound is proven.
    j = joins.asof_join(adds, th, left_ts="time", right_ts="effective_ts", values=["threshold"], strategy=strategy)
    j = j.withColumn("threshold", F.coalesce("threshold", F.lit(views.THRESHOLD_DEFAULT)))
    hits = j.filter(F.col("quantity") > F.col("threshold"))
    return hits.select("event_id", "user_id", "quantity", "threshold",
                       transforms.purchase_message(F.col("user_id"), F.col("quantity"), F.col("sku"),
                                                   F.col("threshold")).alias("message"))


def dynamic_threshold_alerts_scan(spark, sf_dir):
    """J5 for control tables of any size: union + blocked last-value scan, no broadcast."""
    return dynamic_threshold_alerts(spark, sf_dir, strategy="scan")


def dynamic_threshold_large(spark, sf_dir):
    """J5 against a control side that grows with the events and has no key: each signup sets the threshold from its time on."""
    ev = _events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type", "props"])
    control = ev.filter(F.col("event_type") == "signup").select(F.col("ts").alias("eff"), (F.col("event_id") % 7).alias("threshold"), F.col("event_id").alias("control_id"))
    j = joins.asof_join(views.cart_adds(ev), control, left_ts="time", right_ts="eff", values=["threshold"], right_order=["control_id"])
    j = j.withColumn("threshold", F.coalesce("threshold", F.lit(views.THRESHOLD_DEFAULT)).cast("long"))
    return j.filter(F.col("quantity") > F.col("threshold")).select("event_id", "user_id", "quantity", "threshold")


def _edge_sides(spark, sf_dir):
    """Events with null keys and times, and control rows with nulls and several at one time."""
    ev = _events(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"])
    e = F.col("event_id")
    grp = F.when(e % 13 != 0, F.col("user_id") % 7).alias("grp")
    left = ev.select("event_id", grp, F.when(e % 97 != 0, F.col("ts")).alias("ts"))
    control = ev.filter(F.col("event_type") == "signup").select(
        grp, F.when(e % 29 != 0, F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("eff"), (e % 50).alias("threshold"), e.alias("control_id"))
    return left, control


def asof_edge_cases(spark, sf_dir, strategy: str = "broadcast"):
    """J5 with null keys, null times and tied control rows: null keys match, the last control id of a tie counts."""
    left, control = _edge_sides(spark, sf_dir)
    j = joins.asof_join(left, control, left_ts="ts", right_ts="eff", values=["threshold"], by=["grp"], right_order=["control_id"], strategy=strategy)
    return j.select("event_id", _shown("grp"), _shown("threshold"))


def _shown(name: str):
    """A column whose nulls are shown as -1."""
    return F.coalesce(name, F.lit(-1)).cast("long").alias(name)


def asof_edge_cases_scan(spark, sf_dir):
    """The same as a blocked scan: the same answer."""
    return asof_edge_cases(spark, sf_dir, strategy="scan")


def running_count_edge_cases(spark, sf_dir):
    """V2 with null keys and null times: nulls are a key, and come first in time."""
    left, _ = _edge_sides(spark, sf_dir)
    rows, blocks = _blocked(left, ["grp"], "ts")
    return state.running_count(rows, key="grp", order=["ts", "event_id"], **blocks).select("event_id", _shown("grp"), "n")


def session_edge_cases(spark, sf_dir):
    """T11 with null keys and null times: rows without a time are one session of their key."""
    left, _ = _edge_sides(spark, sf_dir)
    rows, blocks = _blocked(left, ["grp"], "ts")
    out = sessions.session_windows(rows, ts="ts", gap_us=10 * 60 * SECOND_US, keys=["grp"], **blocks,
                                   aggs=[F.count(F.lit(1)).alias("events")], tiebreak=["event_id"])
    return out.select(_shown("grp"), *[F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c) for c in ("session_start", "session_end")], "events")


# --------------------------------------------------------------------------- late data

def _late_kw(spark):
    return dict(ts="ts", arrival=views.arrival_order("event_id"),
                block=id_block("event_id", 20 * max(1, block_ids(spark) // 20)),
                window_us=duration_us("30 minutes"), delay_us=duration_us("1 hour"))


def late_events(spark, sf_dir):
    """Rows a 30 min tumbling window with a 1 h bounded-out-of-orderness watermark drops."""
    ev = _events(spark, sf_dir, ["event_id", "ts"])
    out = late.late_events(ev, **_late_kw(spark))
    return out.select("event_id", "ts", "window_end", "watermark")


def late_window_counts(spark, sf_dir):
    """What that window operator emits once late rows are dropped."""
    ev = _events(spark, sf_dir, ["event_id", "ts"])
    return late.on_time_window_counts(ev, **_late_kw(spark))


def late_events_periodic(spark, sf_dir):
    """The same arrivals, window and delay, but the watermark is emitted once in 5 arrivals: rows meet the last emitted one."""
    ev = _events(spark, sf_dir, ["event_id", "ts"])
    group, place, _ = views.arrival_order("event_id")
    out = late.with_periodic_watermark(ev, ts="ts", tick=group * 4 + F.floor(place / 5), window_us=duration_us("30 minutes"), delay_us=duration_us("1 hour"))
    return out.filter("is_late").select("event_id", "ts", "window_end", "watermark")


# --------------------------------------------------------------------------- own accumulators, sources, layouts

def accumulator_top_values(spark, sf_dir):
    """A4/U4: an accumulator of our own: the three greatest whole values, and how often each came, per type and day."""
    ev = _events(spark, sf_dir, ["ts", "event_type", "value"])
    rows = ev.select("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), F.floor("value").cast("long").alias("v"))
    found = accumulate.accumulate(rows, keys=["event_type", "day"], values=["v"], accumulator=accumulate.TopCounts(3), result="top array<long>, counts array<long>")
    shown = F.array_join(F.zip_with("top", "counts", lambda v, n: F.concat(v.cast("string"), F.lit("x"), n.cast("string"))), ", ")
    return found.select("event_type", "day", shown.alias("top"))


def sequence_sources(spark, sf_dir):
    """An inclusive sequence over the ids of the events, and for each number what the events and two literal sources say.

    The literal elements are the record types and their order in a collection; a number without an event, or with
    one of another type, keeps a row.
    """
    ev = _events(spark, sf_dir, ["event_id", "event_type"])
    ends = ev.agg(F.min("event_id").alias("a"), F.max("event_id").alias("b")).first()
    numbers = elements.sequence(spark, ends["a"] or 0, -1 if ends["b"] is None else ends["b"])
    kinds = elements.from_elements(spark, [("purchase", S.ADD_TO_CART), ("error", S.REMOVED_FROM_CART), ("view", S.PRODUCT_VIEWED)], "event_type string, record string")
    ranks = elements.from_collection(spark, [("signup",), ("click",), ("view",), ("purchase",), ("error",)], "event_type string")
    found = numbers.join(ev, numbers["n"] == ev["event_id"], "left").join(F.broadcast(kinds), "event_type", "left").join(F.broadcast(ranks), "event_type", "left")
    return found.select("n", F.coalesce("record", F.lit("none")).alias("record"), F.coalesce("seq", F.lit(-1)).cast("long").alias("seq"))


def layout_report(spark, sf_dir):
    """Q4/Q5: rows and balance of the cart events dealt out evenly, and of the same after the parallelism is lowered without a shuffle."""
    cart = _cart(spark, sf_dir)
    dealt = partitioning.rebalance(cart.repartition(3, "user_id"), 2 * N_TARGETS)
    narrowed = partitioning.set_parallelism(dealt, N_TARGETS)

    def report(name: str, df: DataFrame, n: int) -> DataFrame:
        # round robin begins at a place of its own in each of the 3 tasks before it: partitions differ by 3 rows at most
        held = partitioning.placement(df).agg(F.sum("rows").alias("rows"), F.max("rows").alias("most"), F.count(F.lit(1)).alias("used"))
        even = F.col("most") <= F.col("rows") / n + 3 * (2 * N_TARGETS // n)
        return held.select(F.lit(name).alias("layout"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), (F.col("used") <= n).alias("within"), F.coalesce(even, F.lit(True)).alias("even"))

    return report("dealt", dealt, 2 * N_TARGETS).unionByName(report("narrowed", narrowed, N_TARGETS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tumbling_type_counts": tumbling_type_counts,
    "tumbling_by_type": tumbling_by_type,
    "sliding_counts": sliding_counts,
    "window_value_stats": window_value_stats,
    "registration_windows": registration_windows,
    "busiest_window": busiest_window,
    "session_by_user": session_by_user,
    "session_all": session_all,
    "global_every_10": global_every_10,
    "count_trigger": count_trigger,
    "count_trigger_purging": count_trigger_purging,
    "rolling_reduce": rolling_reduce,
    "reduce_final": reduce_final,
    "running_count_by_user": running_count_by_user,
    "running_type_map": running_type_map,
    "recent_list_by_user": recent_list_by_user,
    "recent_list_ttl": recent_list_ttl,
    "recent_list_ttl_edge_cases": recent_list_ttl_edge_cases,
    "high_quantity_counter": high_quantity_counter,
    "fizzbuzz": fizzbuzz,
    "fizzbuzz_labels": fizzbuzz_labels,
    "map_filter": map_filter,
    "fan_out_pair": fan_out_pair,
    "fan_out_range": fan_out_range,
    "explode_quantity": explode_quantity,
    "threshold_alerts": threshold_alerts,
    "side_output_main": side_output_main,
    "side_output_side": side_output_side,
    "person_codec_roundtrip": person_codec_roundtrip,
    "rich_map": rich_map,
    "event_entities": event_entities,
    "text_sink_roundtrip": text_sink_roundtrip,
    "person_codec_quarantine": person_codec_quarantine,
    "partition_skew": partition_skew,
    "partition_placement": partition_placement,
    "asof_edge_cases": asof_edge_cases,
    "asof_edge_cases_scan": asof_edge_cases_scan,
    "running_count_edge_cases": running_count_edge_cases,
    "session_edge_cases": session_edge_cases,
    "union_sources": union_sources,
    "window_join": window_join,
    "interval_join": interval_join,
    "interval_join_inclusive": interval_join_inclusive,
    "running_ratio": running_ratio,
    "dynamic_threshold_alerts": dynamic_threshold_alerts,
    "dynamic_threshold_alerts_scan": dynamic_threshold_alerts_scan,
    "dynamic_threshold_large": dynamic_threshold_large,
    "late_events": late_events,
    "late_window_counts": late_window_counts,
    "late_events_periodic": late_events_periodic,
    "accumulator_top_values": accumulator_top_values,
    "sequence_sources": sequence_sources,
    "layout_report": layout_report,
}
