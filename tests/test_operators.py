"""Library operators not covered by the query catalogue: literal sources, rich
per-partition functions, custom partitioners, mergeable accumulators, codecs."""

import datetime as dt

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.operators import partitioning, transforms, windows
from tidemark.sources import elements


def test_sources_elements_collection_sequence(spark):
    assert [r["n"] for r in elements.from_elements(spark, [(1,), (2,), (3,), (4,)], "n int").collect()] == [1, 2, 3, 4]
    c = elements.from_collection(spark, [("a",), ("b",)], "x string").collect()
    assert [(r["seq"], r["x"]) for r in c] == [(0, "a"), (1, "b")]
    seq = elements.sequence(spark, 1, 100, partitions=4)
    assert seq.count() == 100 and seq.agg(F.min("n"), F.max("n")).first() == (1, 100)


def test_map_batches_setup_once_per_partition(spark):
    df = spark.range(1, 101, 1, 4).toDF("n")

    def times_ten(batches, factor):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.compute.multiply(b.column(0), factor)], names=["n10"])

    out = transforms.map_batches(df, times_ten, "n10 long", setup=lambda: 10, teardown=lambda r: None)
    assert sorted(r["n10"] for r in out.collect()) == [10 * i for i in range(1, 101)]


def test_partition_custom_places_rows(spark):
    df = spark.createDataFrame([(f"user{i % 7}",) for i in range(200)], "user string")
    n = 4
    placed = partitioning.partition_custom(df, n, partitioning.hash_partitioner("user", n))
    check = placed.select((F.spark_partition_id() == partitioning.hash_partitioner("user", n)).alias("ok"))
    assert check.filter(~F.col("ok")).count() == 0
    report = {(r["partitioner"], r["partition"]): r["rows"] for r in partitioning.partition_report(
        df, n, {"last": partitioning.last_partition(n)}).collect()}
    assert report == {("last", n - 1): 200}
    assert partitioning.rebalance(df, 5).rdd.getNumPartitions() == 5
    assert partitioning.set_parallelism(df.repartition(4), 2).rdd.getNumPartitions() == 2
    assert partitioning.set_parallelism(df, 6, shuffle=True).rdd.getNumPartitions() == 6
    by_key = partitioning.key_partition(df, 3, "user").select("user", F.spark_partition_id().alias("p"))
    assert by_key.distinct().count() == by_key.select("user").distinct().count()
    assert sum(r["rows"] for r in partitioning.placement(placed).collect()) == 200


def test_mergeable_aggregate_and_processing_time(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(seconds=s), float(s)) for s in range(10)],
                               "ts timestamp_ntz, v double")
    out = windows.mergeable_aggregate(df, "ts", "5 seconds", {"c": F.count(F.lit(1)), "s": F.sum("v")},
                                      {"mean": F.col("s") / F.col("c")}).orderBy("window_start").collect()
    assert [r["mean"] for r in out] == [2.0, 7.0]
    pt = windows.processing_time_counts(df, "1 hour")
    assert pt.agg(F.sum("events")).first()[0] == 10


def test_asof_auto_picks_by_counted_size(spark):
    from tidemark.operators import joins
    base = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(i, base + dt.timedelta(seconds=10 * i)) for i in range(12)], "id long, ts timestamp_ntz")
    ctl = spark.createDataFrame([(v, base + dt.timedelta(seconds=25 * v)) for v in range(5)], "th int, eff timestamp_ntz")
    small = joins.asof_join(ev, ctl, left_ts="ts", right_ts="eff", values=["th"], strategy="auto",
                            max_loop_rows=10)
    large = joins.asof_join(ev, ctl, left_ts="ts", right_ts="eff", values=["th"], strategy="auto",
                            max_loop_rows=2)
    assert "BroadcastNestedLoopJoin" in small._jdf.queryExecution().executedPlan().toString() or \
        "Broadcast" in small._jdf.queryExecution().executedPlan().toString()
    want = sorted((i, (10 * i) // 25) for i in range(12))
    assert sorted(map(tuple, small.select("id", "th").collect())) == want
    assert sorted(map(tuple, large.select("id", "th").collect())) == want


def test_session_helpers(spark):
    from tidemark.session import checkpoint_root, cluster_conf, scratch_path
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a").startswith(root.rstrip("/") + "/tidemark/a/")
    conf = cluster_conf(1000, input_tb=100)
    assert int(conf["spark.sql.shuffle.partitions"]) % 1000 == 0
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"


def test_small_column_functions(spark):
    from tidemark.functions import columns
    df = spark.createDataFrame([(7, "nick", dt.datetime(1970, 1, 1, 0, 0, 1, 500_000), {"b": 2, "a": 1})],
                               "id int, name string, ts timestamp_ntz, m map<string,long>")
    got = df.select(columns.entity_id(F.lit("player"), "id", "name"), columns.epoch_millis("ts"), columns.sorted_map_string(F.col("m"))).first()
    assert tuple(got) == ("player|7|nick", 1500, "a=1, b=2")


def test_sums_beyond_64_bits_are_exact(spark):
    from tidemark.operators import state
    from tidemark.operators.scan import id_block
    big = 2**62
    df = spark.createDataFrame([(i, big + i) for i in range(20)], "i long, v long")
    got = state.rolling_reduce(df, key=F.lit(1), value="v", order=["i"], block=id_block("i", 3)).select("i", "running_sum").collect()
    assert {r["i"]: int(r["running_sum"]) for r in got} == {i: sum(big + j for j in range(i + 1)) for i in range(20)}
    assert int(state.reduce_final(df, key=F.lit(1), value="v").first()["total"]) == sum(big + j for j in range(20))


def test_type_counts_of_any_types(spark):
    from tidemark.operators import state
    from tidemark.operators.scan import id_block
    rows = [(i, None if i % 5 == 0 else i % 2, None if i % 7 == 0 else f"t{i % 4}") for i in range(60)]
    df = spark.createDataFrame(rows, "i long, k long, ty string")
    got = state.running_type_counts(df, key="k", type_col="ty", order=["i"], block=id_block("i", 9)).collect()
    seen, want = {}, {}
    for i, k, ty in rows:
        counts = seen.setdefault(k, {})
        if ty is not None:
            counts[ty] = counts.get(ty, 0) + 1
        want[i] = ", ".join(f"{t}={n}" for t, n in sorted(counts.items()))
    assert {r["i"]: r["counts"] for r in got} == want
