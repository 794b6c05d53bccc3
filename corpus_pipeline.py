"""The corpus pipeline: language, near-duplicates, benchmark passages, personal data, packing.

Each stage works on all rows that the one before it kept. Whole rows travel as a struct
beside the text, so no stage depends on ids being there, or being unique.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, op3_disclosure, op4_oph, op5_pack, op6_ecoc, op8_wu_manber, queries
from tidemark.sources.tables import read_table


def _with_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"])


#: A prediction of at least this score replaces a label that says otherwise.
RELABEL_AT = 0.99
#: Words that disclose personal data are hidden if two texts show it (two of two and one more: two thirds).
DISCLOSED_SHARE = 0.6


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one language that the codes, learned from these rows' own labels, can tell.

    Texts without a letter go, and so do ambiguous ones, in which two languages are nearly as close, unless their label confirms
    the prediction. Rows without a label get the predicted one, and a prediction of ``RELABEL_AT`` or more corrects a label that says
    otherwise. If no row has a label, only texts without a letter go.
    """
    common.prepare(spark)
    model = op6_ecoc.train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = op6_ecoc.identify(_with_rows(docs), model, id_col="row")
    label, told = F.col("row.lang"), F.col("lang_pred")
    found = found.where((told != op6_ecoc.UNDETERMINED) & (~F.col("ambiguous") | label.eqNullSafe(told)))
    lang = F.when(label.isNull() | (F.col("score") >= RELABEL_AT), told).otherwise(label)
    return found.select(*[(lang if c == "lang" else F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, a row of the smallest id (null ids after all others).

    Each row has a key of its own here, so rows that repeat an id are one only if their texts are linked, and rows
    without an id are deduplicated like others.
    """
    common.prepare(spark)
    key = "_row_key"
    while key in docs.columns:
        key += "_"
    docs = common.written(spark, docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    found = op4_oph.near_duplicates(docs, id_col=key).select(key, "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key))
    kept = found.join(docs.select(key, "doc_id"), key).groupBy("component_id").agg(first.getField(key).alias(key)).select(key)
    return docs.join(kept, key, "left_semi").drop(key)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark passages."""
    common.prepare(spark)
    found = op8_wu_manber.find_windows(_with_rows(docs), read_table(spark, sf_dir, "benchmark"), id_col="row")
    return queries.contamination(found, "row").where("not contaminated").select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data and the words that disclose it in more than one text replaced; ``n_chars`` follows the text."""
    common.prepare(spark)
    columns = {"text": F.col("clean"), "n_chars": F.char_length("clean").cast("long")}
    found = op3_disclosure.sanitise(docs, least_share=DISCLOSED_SHARE)
    return found.select(*[columns.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens, a row per piece, with its ids as little-endian unsigned 32-bit numbers."""
    common.prepare(spark)
    return op5_pack.pack(docs, public_tokenizers.path(queries.WORD_BPE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("personal_data", personal_data), ("packing", packing)]

#: Tokens, character codes and confirmed links have no SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(spark, stage(spark, docs, sf_dir), name)
    return docs
