"""Partitioning (Q1-Q5): key partitioning, custom partitioners, round-robin, skew reports.

``partition_custom`` is the reference's ``partitionCustom``: the partition id is a
column expression, evaluated by ``repartitionById``. The reference's
``key.hashCode % n`` can be negative; ``pmod`` is used instead.

The reference's "bad" partitioner (everything to partition ``n - 1``) is a lesson
about skew; ``partition_report`` delivers that lesson without building the skewed
layout: it computes where each row *would* go and reports the load per target
partition with a partial (map-side) aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import pmod_hash


def key_partition(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Q1: hash-partition by key (what ``keyBy`` does before a keyed operator)."""
    return df.repartition(n, *keys)


def partition_custom(df: DataFrame, n: int, pid: Column) -> DataFrame:
    """Q2: rows go to partition ``pid`` (must lie in ``[0, n)``)."""
    return df.repartitionById(n, pid)


def hash_partitioner(key: str | Column, n: int) -> Column:
    """Q2: the reference's hash partitioner, without its negative ids."""
    return pmod_hash(key, n)


def last_partition(n: int) -> Column:
    """Q3: the degenerate partitioner: every row to ``n - 1``."""
    return F.lit(n - 1)


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Q4 ``shuffle``: even round-robin redistribution."""
    return df.repartition(n)


def set_parallelism(df: DataFrame, n: int, *, shuffle: bool = False) -> DataFrame:
    """Q5: output parallelism (file count of a sink): ``coalesce`` (narrow, can only
    shrink) or, with ``shuffle``, an even ``repartition``."""
    return df.repartition(n) if shuffle else df.coalesce(n)


def placement(df: DataFrame) -> DataFrame:
    """partition, rows: how many rows each partition of ``df`` holds as it is laid out (empty ones left out)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def partition_report(df: DataFrame, n: int, partitioners: dict[str, Column]) -> DataFrame:
    """Rows per target partition for each partitioner, with the max/mean skew ratio.

    Output: partitioner, partition, rows, share, skew (max rows / mean rows over n
    partitions, 1.0 = perfectly even, n = everything in one partition).
    """
    targets = F.array(*[F.struct(F.lit(name).alias("partitioner"), pid.cast("int").alias("partition")) for name, pid in partitioners.items()])
    parts = df.select(F.explode(targets).alias("t")).select("t.partitioner", "t.partition")
    counts = parts.groupBy("partitioner", "partition").agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.groupBy("partitioner").agg(F.sum("rows").alias("_total"), F.max("rows").alias("_max"))
    return (counts.join(totals, "partitioner")
            .select("partitioner", "partition", "rows",
                    F.round(F.col("rows") / F.col("_total"), 6).alias("share"),
                    F.round(F.col("_max") / (F.col("_total") / F.lit(n)), 6).alias("skew")))
