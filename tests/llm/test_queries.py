"""Every registered training-text query: against its SQL, or against the contract's columns."""

import zlib

import pytest

import __spark_entry__ as E
from conftest import SF001, SF01
from oracle_check import compare, duck

from tidemark.llm.queries import QUERIES, SQL

COLUMNS = {
    "op2": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op3": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4": ["doc_id", "n_shingles", "component_id", "kept"],
    "op5": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op6": ["doc_id", "held_out", "lang_pred", "score"],
    "op7": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op8": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op9": ["query_id", "rank", "vec_id", "score"],
    "op10": ["doc_id", "held_out", "score", "predicted"],
    "op11": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op12": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op13": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    got = compare(spark, SF01, name, E.queries()[name], SQL[name], duck(SF01))
    assert got["match"], got


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = E.queries()[name](spark, SF001)
    number = name.split("_")[0]
    if number not in COLUMNS:
        assert df.count() > 0
        return
    assert df.columns[:len(COLUMNS[number])] == COLUMNS[number]
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    if number not in ("op5", "op9"):
        assert df.count() == n
    if "held_out" in df.columns:
        mod, fold = {"op6": (5, 0), "op7": (7, 2), "op10": (4, 2), "op13": (5, 0)}[number]
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == fold) for r in df.collect())


def test_all_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
