"""Physical-plan properties that matter at scale, checked on the static plan with
broadcasts disabled (as if every table were large)."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF01
from tidemark.plans.catalog import QUERIES as CATALOG

Q = {n: f for n, f in E.queries().items() if n in CATALOG}


@pytest.fixture()
def big_tables(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.tidemark.scan.blockRows", "15")
    yield spark
    spark.conf.unset("spark.tidemark.scan.blockRows")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(spark, name):
    return Q[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(n for n in Q if not n.startswith("streaming_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_single_partition_exchange_on_data(big_tables, name):
    p = plan(big_tables, name)
    assert "CartesianProduct" not in p
    # single-partition steps are allowed only over tiny tables: the literal control
    # table, or a block table (one aggregated row per time block), never over rows
    lines = p.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = []
            for child in lines[i + 1:]:
                if depth(child) <= depth(line):
                    break
                below.append(child)
            text = "\n".join(below)
            # all the way down: rows of a table only as partial aggregates
            assert "events.parquet" not in text or "Aggregate(key" in text.split("FileScan")[0], name


def row_exchanges(p: str) -> list[str]:
    """Exchanges that move rows (not partial aggregates): the node below is not a HashAggregate."""
    lines = p.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and i + 1 < len(lines):
            if "HashAggregate" not in lines[i + 1]:
                out.append(line.strip())
    return out


@pytest.mark.parametrize("name", ["running_count_by_user",
                                  "global_every_10", "running_ratio", "rolling_reduce"])
def test_ordered_scan_shuffles_rows_once(big_tables, name):
    """One row shuffle on (key, block); block totals move as partial aggregates, the
    block-offset tables are small, and the join back reuses the row partitioning."""
    p = plan(big_tables, name)
    moved = [e for e in row_exchanges(p) if re.search(r"_blk#\d+L?, \d+\)", e)]
    assert len(moved) == 2, moved  # the rows, and the small offsets side of the join back
    assert "BroadcastNestedLoopJoin" not in p


def test_filters_and_columns_reach_the_scan(big_tables):
    p = plan(big_tables, "explode_quantity")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in p or \
        "EqualTo(event_type,purchase)" in p
    assert "value" not in re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)


def test_interval_join_is_equi_join_on_user_and_bucket(big_tables):
    p = plan(big_tables, "interval_join")
    assert re.search(r"SortMergeJoin \[user_id#\d+L, _bucket#\d+L\]", p)
    assert "BroadcastNestedLoopJoin" not in p


def test_busiest_window_is_distributed_top1(big_tables):
    assert "TakeOrderedAndProject(limit=1" in plan(big_tables, "busiest_window")


@pytest.mark.parametrize("name", ["running_count_by_user", "session_by_user", "session_all", "global_every_10", "running_ratio", "count_trigger", "rolling_reduce"])
def test_scans_read_the_rows_once(big_tables, name):
    """The plan reads the rows once; measures and totals are small tables made before."""
    assert len(re.findall(r"FileScan parquet[^\n]*events.parquet", plan(big_tables, name))) == 1


def test_small_keys_are_one_window(spark):
    """Nothing to cut: one read, one shuffle."""
    p = plan(spark, "running_count_by_user")
    assert len(re.findall(r"FileScan parquet[^\n]*events.parquet", p)) == 1 and p.count("Exchange hashpartitioning") == 1
