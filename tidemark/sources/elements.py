"""Bounded literal sources (S1-S3) — for fixtures and small control tables.

Registered queries never run on these alone; they read the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_elements(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """S1 ``fromElements``: literal rows with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def from_collection(spark: SparkSession, rows: list, schema: T.StructType | str, seq: str = "seq") -> DataFrame:
    """S2 ``fromCollection``: like S1 plus the collection order as a ``seq`` column."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               T.StructType([T.StructField(seq, T.LongType()), *_fields(spark, schema)]))
    return df


def sequence(spark: SparkSession, start: int, end: int, name: str = "n", partitions: int | None = None) -> DataFrame:
    """S3 ``fromSequence(start, end)``: **inclusive** range, split over partitions."""
    return spark.range(start, end + 1, 1, partitions).select(F.col("id").alias(name))


def _fields(spark: SparkSession, schema: T.StructType | str) -> list[T.StructField]:
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    return list(schema.fields)
