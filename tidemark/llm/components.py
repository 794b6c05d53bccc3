"""Connected components of a graph held in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import batches, common

#: So many edges one task may hold; more take rounds over the cluster. Both give the same roots.
ONE_TASK_EDGES = 200_000


def _union_find(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in rows_in:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    found = ((v, root(v)) for v in list(parent) if root(v) != v)
    yield from batches.record_batches(found, pa.schema([("v", pa.int64()), ("root", pa.int64())]))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, one_task_edges: int = ONE_TASK_EDGES) -> DataFrame:
    """(v, root): the smallest vertex reachable from each vertex of ``edges`` (u, v) but the roots themselves.

    Up to ``one_task_edges`` edges (counted) are joined up in one task. More take rounds of large and small stars: each vertex hands its larger (smaller) neighbours to the
    smallest vertex it knows, until nothing changes and every edge leads to a root. Minima are
    taken by partial aggregation, so a vertex with very many edges is no hot group. Each
    round is written to the shared folder, so the plan doesn't grow.
    """
    spark = edges.sparkSession
    edges = common.written(spark, edges.where("u <> v").select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u")).distinct(), "edges")
    if edges.limit(one_task_edges + 1).count() <= one_task_edges:
        return edges.select("u", "v").coalesce(1).mapInArrow(_union_find, "v long, root long")
    before = None
    while True:
        # large star: all neighbours; those beyond u go to the least
        near = _both_ways(edges)
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = near.where("v > u").join(least, "u").where("v <> m").select("v", F.col("m").alias("u")).distinct()
        # small star: the neighbours before v, and v itself, go to the least
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(least, "v")
        small = joined.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(joined.select("v", F.col("m").alias("u"))).distinct()
        edges = common.written(spark, small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select("v", F.col("u").alias("root"))
        before = now
