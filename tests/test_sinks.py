"""Sinks and codecs: text sink parallelism, foreach writer, JDBC round trip (in-process
Derby, no server), Kafka record projection, codec strict/quarantine modes."""

import glob

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tidemark.session import scratch_path
from tidemark.sinks import external, files
from tidemark.sources import tables
from tidemark.sources.codecs import decode_person, encode_person
from tidemark.streaming.replay import file_stream, line_stream, run_available_now


@pytest.fixture(scope="module")
def people(spark):
    """(name, age) of a few customers."""
    cust = tables.read_table(spark, SF001, "customer", ["c_name", "c_nationkey", "c_custkey"])
    return cust.filter("c_custkey % 40 = 3").select(F.col("c_name").alias("name"), F.col("c_nationkey").cast("int").alias("age"))



def test_text_sink_parallelism(spark):
    df = spark.range(1, 101).toDF("n").filter("n % 15 = 0")
    one, three = scratch_path(spark, "test", "one"), scratch_path(spark, "test", "three")
    files.write_text(df, one, parallelism=1)
    files.write_text(spark.range(30).toDF("n").repartition(6), three, parallelism=3, name="FizzBuzzResult")
    assert len(glob.glob(f"{one}/part-*")) == 1
    assert len(glob.glob(f"{three}/part-*")) == 3
    assert sorted(int(x) for x in spark.read.text(one).toPandas()["value"]) == [15, 30, 45, 60, 75, 90]
    assert spark.read.text(three).first()["value"].startswith("FizzBuzzResult(")


def test_streaming_file_sink_and_foreach_writer(spark):
    src = scratch_path(spark, "test", "lines_src")
    spark.createDataFrame([("first line",), ("second line",), ("third line",)], "line string") \
        .coalesce(1).write.text(src)
    stream = file_stream(spark, src, spark.read.text(src).schema, fmt="text")
    out = run_available_now(spark, stream, "lines")
    assert sorted(r["value"] for r in out.collect()) == ["first line", "second line", "third line"]
    target = scratch_path(spark, "test", "foreach")
    write = external.line_directory_writer(target)
    external.foreach_batch(stream, write, scratch_path(spark, "test", "fck")).awaitTermination()
    write(spark.read.text(src), 0)  # an epoch that is run again replaces its lines
    assert sorted(r["value"] for r in spark.read.text(target).collect()) == ["first line", "second line", "third line"]


def test_foreach_writer_sees_every_row(spark):
    seen = spark.sparkContext.accumulator(0)

    class Count:
        def process(self, row):
            seen.add(len(row["value"]))

    src = scratch_path(spark, "test", "foreach_src")
    spark.createDataFrame([("abc",), ("de",)], "line string").coalesce(1).write.text(src)
    stream = file_stream(spark, src, spark.read.text(src).schema, fmt="text")
    external.foreach_rows(stream, Count(), scratch_path(spark, "test", "fck2")).awaitTermination()
    assert seen.value == 5


def test_append_text_adds_lines(spark):
    target = scratch_path(spark, "test", "append")
    for n in (1, 2):
        files.append_text(spark.range(n, n + 2).toDF("n"), target, name="Row")
    assert sorted(r["value"] for r in spark.read.text(target).collect()) == ["Row(1)", "Row(2)", "Row(2)", "Row(3)"]


def test_jdbc_round_trip_with_derby(spark, people):
    opts = external.jdbc_options("jdbc:derby:memory:tidemark_people;create=true", "people",
                                 driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    external.write_jdbc(people.limit(0), opts, mode="overwrite")
    external.write_jdbc(people, opts, columns=["name", "age"])
    back = external.read_jdbc(spark, opts)
    assert sorted((r[0], r[1]) for r in back.select(*back.columns[:2]).collect()) == sorted(map(tuple, people.collect()))
    assert [c.lower() for c in back.columns] == ["name", "age"]
    split = external.read_jdbc(spark, opts, partition_column=back.columns[1], lower=0, upper=25, partitions=3)
    assert split.rdd.getNumPartitions() == 3 and split.count() == back.count()


def test_kafka_records_and_codec(spark, people):
    recs = external.kafka_records(people)
    assert recs.schema["value"].dataType.simpleString() == "binary"
    assert sorted(map(tuple, decode_person(recs).collect())) == sorted(map(tuple, people.collect()))
    bad = spark.createDataFrame([("Zed,notanumber",), ("Uma,7,extra",), ("nocomma",), (None,)], "value string")
    q = decode_person(bad, mode="quarantine").collect()
    assert [(r["name"], r["age"]) for r in q] == [(None, None), ("Uma", 7), (None, None), (None, None)]
    assert [r["_corrupt"] for r in q] == ["Zed,notanumber", None, "nocomma", None]


@pytest.mark.parametrize("record", ["Zed,notanumber", "nocomma", None])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_decoding_fails(spark, record, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a person record"):
            decode_person(spark.createDataFrame([(record,)], "value string")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_records_that_cannot_be_encoded(spark):
    odd = spark.createDataFrame([(None, 5), ("Uma", None), ("a,b", 1), ("Uma", 7)], "name string, age int")
    got = encode_person(odd, mode="quarantine").collect()
    assert [None if r["value"] is None else r["value"].decode() for r in got] == [None, None, None, "Uma,7"]
    assert [r["_corrupt"] for r in got] == ["null,5", "Uma,null", "a,b,1", None]
    for row in odd.collect()[:3]:
        with pytest.raises(Exception, match="not a person record"):
            encode_person(spark.createDataFrame([row], odd.schema)).collect()


def test_customer_codec_round_trip(spark):
    cust = tables.read_table(spark, SF001, "customer", ["c_name", "c_nationkey"])
    people = cust.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("age"))
    back = decode_person(encode_person(people))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, people.collect()))


def test_cassandra_and_kafka_options():
    assert external.cassandra_options("ks", "people", "localhost") == {
        "keyspace": "ks", "table": "people", "spark.cassandra.connection.host": "localhost"}
    assert external.jdbc_options("jdbc:x", "t", user="u", password="p")["user"] == "u"


def test_streaming_jdbc_via_foreach_batch(spark):
    opts = external.jdbc_options("jdbc:derby:memory:tidemark_stream;create=true", "lines",
                                 driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    src = scratch_path(spark, "test", "jdbc_src")
    spark.createDataFrame([("a",), ("b",), ("c",)], "line string").coalesce(1).write.parquet(src)
    external.write_jdbc(spark.createDataFrame([], "line string"), opts, mode="overwrite")
    stream = file_stream(spark, src, spark.read.parquet(src).schema)
    q = external.foreach_batch(stream, external.jdbc_batch_writer(opts, ["line"]),
                               scratch_path(spark, "test", "jdbc_ck"))
    q.awaitTermination()
    assert sorted(r[0] for r in external.read_jdbc(spark, opts).collect()) == ["a", "b", "c"]


def test_line_stream_into_text_file_sink(spark):
    """S6 line source -> K3 row-format streaming file sink (committed per micro-batch)."""
    src = scratch_path(spark, "test", "lines2")
    spark.createDataFrame([("x",), ("y",)], "line string").coalesce(1).write.text(src)
    out = scratch_path(spark, "test", "lines2_out")
    q = files.stream_to_files(line_stream(spark, src).select(F.col("line").alias("value")), out,
                              out + "_ck", fmt="text", available_now=True)
    q.awaitTermination()
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ["x", "y"]


def test_trigger_cadence(spark):
    """T5: a micro-batch every so often, over what has landed by then."""
    src, out = scratch_path(spark, "test", "cadence"), scratch_path(spark, "test", "cadence_out")
    spark.createDataFrame([("a",)], "line string").coalesce(1).write.text(src)
    q = files.stream_to_files(line_stream(spark, src).select(F.col("line").alias("value")), out, out + "_ck", fmt="text", trigger="500 milliseconds")
    q.processAllAvailable()
    spark.createDataFrame([("b",)], "line string").coalesce(1).write.mode("append").text(src)
    q.processAllAvailable()
    q.stop()
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ["a", "b"]
    assert len({p["batchId"] for p in q.recentProgress if p["numInputRows"]}) == 2


def test_print_sinks(spark, capsys):
    """K1: print() for bounded output and the console sink for streams."""
    files.show(spark.createDataFrame([(1, "a")], "n int, s string"))
    assert "a" in capsys.readouterr().out
    src = scratch_path(spark, "test", "console_src")
    spark.createDataFrame([("hello",)], "line string").coalesce(1).write.parquet(src)
    st = file_stream(spark, src, spark.read.parquet(src).schema)
    q = files.console_stream(st, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
