"""Shared small helpers of the ``llm`` operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.session import scratch_path
from tidemark.sources.tables import read_table

#: Rows and bytes of one Arrow batch: they bound what a Python worker holds at once (a longer text is a batch of its own).
ARROW_ROWS = 512
ARROW_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators (batch size of the Python workers)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) under fixed names, whatever else the input has; a null text becomes empty."""
    return docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def output(docs: DataFrame, id_col: str, ddl: str, name: str | None = None) -> StructType:
    """The id, of whatever type (it may be a struct of a whole row), and the columns of ``ddl``."""
    kind = docs.select(docs[id_col]).schema.fields[0].dataType
    return StructType([StructField(name or id_col, kind), *StructType.fromDDL(ddl).fields])


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, and lost executors can't take it."""
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(id_col: str, n: int):
    """crc32 of the id as text, modulo n: the folds of the held-out rows."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n
