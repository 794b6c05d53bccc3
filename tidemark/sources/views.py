"""Derived event views (FIXTURES.md section 2), defined identically in the DuckDB oracles.

The reference's generators are random and wall-clock driven; instead its record
types are derived from the driver's ``events`` table, so every query's work grows
with that table:

* ``cart``           purchase -> AddToShoppingCartEvent, error -> RemovedFromShoppingCartEvent
* ``catalog``        view -> ProductDetailsViewed
* ``server_events``  signup -> PlayerRegistered, click -> PlayerOnline, others unchanged
* ``thresholds``     effective-dated control rows (the broadcast control stream)
* arrival order      a deterministic out-of-order arrival key for late-data replay
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import json_int


def cart(events: DataFrame) -> DataFrame:
    """Shopping-cart events (adds and removals) as one discriminated row type."""
    k = json_int("props", "k")
    return (events
            .filter(F.col("event_type").isin("purchase", "error"))
            .select(
                "event_id",
                F.when(F.col("event_type") == "purchase", F.lit(S.ADD_TO_CART))
                 .otherwise(F.lit(S.REMOVED_FROM_CART)).alias("event_type"),
                "user_id",
                F.concat(F.lit("sku_"), F.floor(k / 10).cast("int").cast("string")).alias("sku"),
                (k % 10).alias("quantity"),
                F.col("ts").alias("time")))


def cart_adds(events: DataFrame) -> DataFrame:
    """Filter by record type + downcast (only AddToShoppingCartEvent rows)."""
    return cart(events.filter(F.col("event_type") == "purchase"))


def catalog(events: DataFrame) -> DataFrame:
    return (events
            .filter(F.col("event_type") == "view")
            .select("event_id",
                    F.lit(S.PRODUCT_VIEWED).alias("event_type"),
                    "user_id",
                    json_int("props", "k").cast("string").alias("product_id"),
                    F.col("ts").alias("time")))


def server_events(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    return events.select(
        "event_id",
        F.when(et == "signup", F.lit(S.PLAYER_REGISTERED))
         .when(et == "click", F.lit(S.PLAYER_ONLINE))
         .otherwise(et).alias("event_type"),
        F.col("user_id").alias("player_id"),
        "ts")


# The control stream of thresholds 2,0,4,5,6,3 in this order, one
# every 5 days from 2024-01-06 (FIXTURES.md); before the first one the threshold is 0.
THRESHOLD_VALUES = (2, 0, 4, 5, 6, 3)
THRESHOLD_FIRST = dt.datetime(2024, 1, 6)
THRESHOLD_PERIOD = dt.timedelta(days=5)
THRESHOLD_DEFAULT = 0


def thresholds(spark: SparkSession) -> DataFrame:
    rows = [(v, THRESHOLD_FIRST + i * THRESHOLD_PERIOD) for i, v in enumerate(THRESHOLD_VALUES)]
    return spark.createDataFrame(rows, S.THRESHOLDS)


def arrival_order(event_id: str | Column = "event_id") -> list[Column]:
    """Deterministic out-of-order arrival: groups of 20 ids, permuted by ``7*id mod 20``.

    Returned as sort columns instead of a materialised global ``row_number`` (that
    would need every row in one task); ``event_id div 20`` doubles as a natural
    scan block because arrival order is monotone in it.
    """
    e = F.col(event_id) if isinstance(event_id, str) else event_id
    return [F.floor(e / 20), (e * 7) % 20, e]
