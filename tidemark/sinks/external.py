"""External sinks and sources (K5-K8, S7, S8): foreach writers, JDBC, Kafka, Cassandra.

Connector jars for Kafka and Cassandra are not bundled; the functions below are
the standard Spark calls and option sets and work once the cluster has them.
JDBC runs against any driver on the classpath (tests use in-process Derby).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.codecs import decode_person, encode_person


def line_directory_writer(directory: str, column: str = "value"):
    """K5 custom sink as a ``foreachBatch`` function: each epoch is a folder of text lines of its own,
    replaced when the epoch is run again (so retries don't repeat lines). Spark writes it, so
    ``directory`` may be on any file system it knows."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(f"{directory.rstrip('/')}/epoch={epoch_id}")
    return write


def foreach_rows(stream: DataFrame, writer, checkpoint: str, *, available_now: bool = True):
    w = stream.writeStream.foreach(writer).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def foreach_batch(stream: DataFrame, fn, checkpoint: str, *, available_now: bool = True):
    """Batch-oriented targets: ``fn(batch_df, epoch_id)``; make ``fn`` idempotent per epoch."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


# ----------------------------------------------------------------------------- JDBC (K6)

def jdbc_options(url: str, table: str, *, driver: str | None = None, user: str | None = None,
                 password: str | None = None, batch_size: int = 1000) -> dict:
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    if driver:
        opts["driver"] = driver
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    return opts


def write_jdbc(df: DataFrame, options: dict, *, columns: list[str] | None = None, mode: str = "append") -> None:
    """K6: batched parameterised INSERTs of ``columns`` (the statement builder's bindings)."""
    out = df.select(*columns) if columns else df
    out.write.format("jdbc").options(**options).mode(mode).save()


def jdbc_batch_writer(options: dict, columns: list[str] | None = None):
    """``foreachBatch`` function appending each micro-batch over JDBC (at-least-once)."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        write_jdbc(batch, options, columns=columns)
    return write


def read_jdbc(spark: SparkSession, options: dict, *, partition_column: str | None = None, lower: int = 0, upper: int = 0,
              partitions: int = 1) -> DataFrame:
    """A table over JDBC; with a numeric ``partition_column`` and its bounds, by ``partitions`` tasks."""
    if partition_column:
        options = options | {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(**options).load()


# ----------------------------------------------------------------------------- Kafka

def kafka_stream(spark: SparkSession, bootstrap: str, topic: str, *, group_id: str | None = None,
                 starting_offsets: str = "earliest") -> DataFrame:
    """Value-only string stream from a topic (no watermark: T3)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return r.load().select(F.col("value").cast("string").alias("value"))


def kafka_people(spark: SparkSession, bootstrap: str, topic: str, *, mode: str = "strict", **kw) -> DataFrame:
    """``Person`` records decoded from ``name,age`` values."""
    return decode_person(kafka_stream(spark, bootstrap, topic, **kw), mode=mode)


def kafka_records(df: DataFrame, *, name: str = "name", age: str = "age") -> DataFrame:
    """K8 serialization schema: ``value`` = UTF-8 bytes of ``name,age``."""
    return encode_person(df, name, age)


def write_kafka(records: DataFrame, bootstrap: str, topic: str) -> None:
    records.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()


def stream_kafka(records: DataFrame, bootstrap: str, topic: str, checkpoint: str):
    """K8 for streams: the same records, checkpointed."""
    return (records.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


# ----------------------------------------------------------------------------- Cassandra (K7)

CASSANDRA_FORMAT = "org.apache.spark.sql.cassandra"


def cassandra_options(keyspace: str, table: str, host: str | None = None) -> dict:
    opts = {"keyspace": keyspace, "table": table}
    if host:
        opts["spark.cassandra.connection.host"] = host
    return opts


def write_cassandra(df: DataFrame, options: dict, columns: list[str]) -> None:
    """K7: tuples of ``columns`` upserted by primary key (Cassandra INSERT semantics)."""
    df.select(*columns).write.format(CASSANDRA_FORMAT).options(**options).mode("append").save()
