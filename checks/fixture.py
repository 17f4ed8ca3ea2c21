"""Bars from ``lineitem`` read as trades, and the constants that suit their weekly grid."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import Grid
from tidemark.operators.bars import bars_from_trades

GRID = Grid(bar=timedelta(days=7), origin=datetime(1995, 1, 2), part_days=364)
LOOKBACK = 10
HORIZONS = (1, 2, 3, 7)
BUCKET = 10
BEFORE = 8
AFTER = 6
STOP_RATIO = 0.05
PROFIT_RATIO = 3.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_range(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """The first and the last part that hold trades."""
    shipped = table(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high")
    )
    parts = shipped.select(*(GRID.part(GRID.number(F.col(c))) for c in ("low", "high")))
    return tuple(parts.first())


def trade_rank() -> Column:
    """One number that orders trades by day, order, line, part and price."""
    digits = [
        (F.datediff(F.to_date("l_shipdate"), F.lit(GRID.origin.date())), 5),
        (F.col("l_orderkey"), 11),
        (F.col("l_linenumber"), 2),
        (F.col("l_partkey"), 9),
        (F.round(F.col("l_extendedprice") * 100), 10),
    ]
    shift, rank = 0, F.lit(0).cast("decimal(38,0)")
    for value, places in reversed(digits):
        rank = rank + value.cast("decimal(11,0)") * F.lit(str(10**shift)).cast(f"decimal({shift + 1},0)")
        shift += places
    return rank.cast("decimal(38,0)")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier is a symbol, each line a trade of whole quantities at prices of two decimals."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return bars_from_trades(
        table(spark, sf_dir, "lineitem"),
        GRID,
        symbol=F.col("l_suppkey"),
        ts=F.col("l_shipdate"),
        price=price,
        coins=F.col("l_quantity").cast("bigint"),
        usd=F.col("l_extendedprice").cast("decimal(18,2)"),
        taker_buys=F.col("l_returnflag") == "N",
        order=[trade_rank()],
    )
