"""Every registered query vs its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF001, SF01
from oracle_check import compare, duck
from tidemark.plans.catalog import QUERIES as CATALOG
from tidemark.streaming.twins import STREAMING_QUERIES

# the training-text queries have their own tests
QUERIES = {n: f for n, f in E.queries().items() if n in CATALOG or n in STREAMING_QUERIES}
SQL = {n: s for n, s in E.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF01, name, QUERIES[name], SQL.get(name), con)
    if SQL.get(name) is None:
        assert res["spark_rows"] > 0
    else:
        assert res["match"], res


def test_every_query_has_an_oracle_or_a_reason():
    rows_only = set()
    assert set(QUERIES) - set(SQL) == rows_only


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["window_start", "window_end", "registrations", "events"]
    assert df.count() > 0


def test_queries_run_at_smallest_scale(spark):
    for name, fn in QUERIES.items():
        if name.startswith("streaming_"):
            continue
        assert fn(spark, SF001).count() >= 0


SCAN_QUERIES = ["session_by_user", "session_all", "global_every_10", "count_trigger", "count_trigger_purging",
                "rolling_reduce", "running_count_by_user", "running_type_map", "recent_list_by_user",
                "high_quantity_counter", "running_ratio", "late_events", "late_window_counts", "asof_edge_cases_scan",
                "running_count_edge_cases", "session_edge_cases", "dynamic_threshold_alerts_scan", "recent_list_ttl", "recent_list_ttl_edge_cases",
                "late_events_periodic"]


def test_scans_with_hot_keys_and_fine_blocks(spark, con):
    """Force the hot-key path (fine blocks) and many small blocks: same answers."""
    conf = {"spark.tidemark.scan.blockRows": "15", "spark.tidemark.scan.blockIds": "40"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for name in SCAN_QUERIES:
            res = compare(spark, SF01, name, QUERIES[name], SQL[name], con)
            assert res["match"], res
    finally:
        for k in conf:
            spark.conf.unset(k)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def test_column_types_match_oracle(spark, con):
    """Same names and the same types, so value hashes compare like with like."""
    for name, sql in SQL.items():
        if name.startswith("streaming_"):
            continue
        st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in QUERIES[name](spark, SF01).schema.fields}
        dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        assert st == dt, name
