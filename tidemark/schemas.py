"""Static schemas and discriminator values. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Record-type names used as discriminators. They must equal the
# reference's class names because outputs (keys, map renderings) show them.
ADD_TO_CART = "AddToShoppingCartEvent"
REMOVED_FROM_CART = "RemovedFromShoppingCartEvent"
PRODUCT_VIEWED = "ProductDetailsViewed"
PLAYER_REGISTERED = "PlayerRegistered"
PLAYER_ONLINE = "PlayerOnline"
PLAYER_OFFLINE = "PlayerOffline"
LOOKING_FOR_GAME = "PlayerIsLookingForAGame"
GAME_STARTED = "GameStarted"
GAME_FINISHED = "GameFinished"
# The text of the demos' output messages (printf-style).
PURCHASE_ALERT = "User %s attempting to purchase %s items of %s when threshold is %s"
BROWSED_AND_BOUGHT = "User %s browsed at %s and bought at %s"
# The four game types, in declaration order.
GAME_TYPES = ("OneVsOne", "TwoVsTwo", "ThreeVsThree", "FourVsFour")

# Driver table `events` (TESTDATA.md).
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Shopping-cart events: one wide row with a discriminator (sum type).
CART = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("sku", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("time", T.TimestampNTZType()),
])

CATALOG = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("time", T.TimestampNTZType()),
])

# Gaming server events: variant-only columns are nullable.
SERVER_EVENTS = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("player_id", T.StringType()),
    T.StructField("nickname", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("game_id", T.StringType()),
    T.StructField("player_ids", T.ArrayType(T.StringType())),
    T.StructField("map_id", T.StringType()),
    T.StructField("region_id", T.StringType()),
    T.StructField("game_type", T.StringType()),
])

PERSON = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
])

THRESHOLDS = T.StructType([
    T.StructField("threshold", T.IntegerType()),
    T.StructField("effective_ts", T.TimestampNTZType()),
])
