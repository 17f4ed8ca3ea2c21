"""Column names and types of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

HIGH = "highest_price_in_usd"
LOW = "the_lowest_price_in_usd"
OPEN = "opening_price_in_usd"
CLOSE = "closing_price_in_usd"
USD = "volume_in_usd"
COINS = "volume_in_coins"
TAKER_BUY_COINS = "volume_in_coins_when_taker_buy_coins"
TAKER_SELL_USD = "volume_in_usd_when_taker_sell_coins"
TRANSACTIONS = "transactions_per_minute"
AVG = "avg_price_in_usd"

# Output column names of the training set.
ENTRY = "target_price_in_in_usd"
GAIN = "gain_1_pct"
BEST = "chery_max_avg_price_in_usd"
RISES = "feature_sum_of_posetiv_changes_in_backlist_for_avg_prices_changed_per_1minute_pct"
FALLS = "feature_sum_of_negativ_changes_in_backlist_for_avg_prices_changed_per_1minute_pct"
MOVES = "feature_sum_of_changes_in_backlist_for_avg_prices_changed_per_1minute_pct"
STEP = "feature_avg_prices_changed_per_1minute_pct"
AVG_VOLUME = "avg_vol_per_min"

BARS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("time_open", T.TimestampNTZType()),
        T.StructField("date", T.DateType()),
        T.StructField(OPEN, T.DoubleType()),
        T.StructField(HIGH, T.DoubleType()),
        T.StructField(LOW, T.DoubleType()),
        T.StructField(CLOSE, T.DoubleType()),
        T.StructField(USD, T.DoubleType()),
        T.StructField(COINS, T.DoubleType()),
        T.StructField(TAKER_BUY_COINS, T.DoubleType()),
        T.StructField(TAKER_SELL_USD, T.DoubleType()),
        T.StructField(TRANSACTIONS, T.LongType()),
    ]
)

TARGETS = T.StructType(
    [
        T.StructField("target_name", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("part_name", T.DateType()),
        T.StructField("time_open", T.TimestampNTZType()),
        T.StructField("value", T.FloatType()),
    ]
)

TRAINING = T.StructType(
    [
        T.StructField("part_name", T.DateType()),
        T.StructField(ENTRY, T.DoubleType()),
        T.StructField(GAIN, T.DoubleType()),
        T.StructField(BEST, T.DoubleType()),
        T.StructField("target_name", T.StringType()),
        T.StructField("target_value", T.FloatType()),
        T.StructField("target_timestamp", T.TimestampNTZType()),
        T.StructField("target_symbol", T.StringType()),
        T.StructField(RISES, T.DoubleType()),
        T.StructField(FALLS, T.DoubleType()),
        T.StructField(MOVES, T.DoubleType()),
        T.StructField(AVG_VOLUME, T.DoubleType()),
    ]
)

DIGESTS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("digest", T.StringType()),
    ]
)

VERSION = T.StructField("row_version", T.TimestampType())

# Sort keys of the stored tables: at most one current row each.
TARGET_KEY = ["target_name", "symbol", "part_name", "time_open"]
TRAINING_KEY = ["part_name", "target_name", "target_symbol", "target_timestamp"]


def stored(schema: T.StructType) -> T.StructType:
    """A table as it lies on disk: its columns and the version stamped at write."""
    return T.StructType([*schema.fields, VERSION])
