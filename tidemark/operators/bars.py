"""Building bars and looking back along them.

Bars are unique per (symbol, time_open); ``bars_from_trades`` makes them so. That bounds every
(symbol, part) group by the number of bars in a part, however busy the symbol is.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.prices import avg_price
from tidemark.grid import Grid


def partial_bars(
    trades: DataFrame,
    grid: Grid,
    *,
    symbol: Column,
    ts: Column,
    price: Column,
    coins: Column,
    usd: Column,
    taker_buys: Column,
    order: list[Column],
) -> DataFrame:
    """What ``merged_bars`` needs to know of some trades: one row per symbol and bar.

    Rows of several loads can be stored beside each other, and late trades be added without reading the
    earlier ones again. The opening and the closing price stand with their rank; sums keep the type that exact
    sums of the input have.
    """
    rows = trades.select(
        symbol.cast("string").alias("symbol"),
        grid.number(ts).alias("bar_no"),
        price.alias("price"),
        coins.alias("coins"),
        usd.alias("usd"),
        taker_buys.alias("taker_buys"),
        (order[0] if len(order) == 1 else F.struct(*order)).alias("rank"),
    )
    buys = F.col("taker_buys")
    found = rows.groupBy("symbol", "bar_no").agg(
        F.min("rank").alias("open_rank"),
        F.min_by("price", "rank").alias("open"),
        F.max("rank").alias("close_rank"),
        F.max_by("price", "rank").alias("close"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("usd").alias("usd"),
        F.sum("coins").alias("coins"),
        F.sum(F.when(buys, F.col("coins"))).alias("buy_coins"),
        F.sum(F.when(~buys, F.col("usd"))).alias("sell_usd"),
        F.count(F.lit(1)).alias("trades"),
    )
    return found.withColumn("date", grid.part(F.col("bar_no")))


def merged_bars(partial: DataFrame, grid: Grid) -> DataFrame:
    """Bars from ``partial_bars`` of any number of loads, each trade of which is in one of them.

    The aggregates are extremes and sums, so merging loads gives the bars of all their trades at once.
    """
    zero = F.lit(0.0)
    merged = partial.groupBy("symbol", "bar_no").agg(
        F.min_by("open", "open_rank").alias(S.OPEN),
        F.max("high").alias(S.HIGH),
        F.min("low").alias(S.LOW),
        F.max_by("close", "close_rank").alias(S.CLOSE),
        F.sum("usd").cast("double").alias(S.USD),
        F.sum("coins").cast("double").alias(S.COINS),
        F.coalesce(F.sum("buy_coins").cast("double"), zero).alias(S.TAKER_BUY_COINS),
        F.coalesce(F.sum("sell_usd").cast("double"), zero).alias(S.TAKER_SELL_USD),
        F.sum("trades").alias(S.TRANSACTIONS),
    )
    number = F.col("bar_no")
    return merged.withColumns({"time_open": grid.start(number), "date": grid.part(number)}).select(*S.BARS.names)


def bars_from_trades(
    trades: DataFrame,
    grid: Grid,
    *,
    symbol: Column,
    ts: Column,
    price: Column,
    coins: Column,
    usd: Column,
    taker_buys: Column,
    order: list[Column],
) -> DataFrame:
    """Open/high/low/close bars with volumes per symbol and bar.

    ``order`` decides which trade opens and closes a bar. One orderable number or timestamp (a trade
    id) keeps the aggregation hash-based; several columns are compared as a struct and make it
    sort-based where the opening or closing price is read. Pass ``coins`` and ``usd`` as integer or
    decimal columns to get sums that do not depend on the order of the rows.
    """
    rows = trades.select(
        symbol.cast("string").alias("symbol"),
        grid.number(ts).alias("bar_no"),
        price.alias("price"),
        coins.alias("coins"),
        usd.alias("usd"),
        taker_buys.alias("taker_buys"),
        (order[0] if len(order) == 1 else F.struct(*order)).alias("rank"),
    )
    buys = F.col("taker_buys")
    bars = rows.groupBy("symbol", "bar_no").agg(
        F.min_by("price", "rank").alias(S.OPEN),
        F.max("price").alias(S.HIGH),
        F.min("price").alias(S.LOW),
        F.max_by("price", "rank").alias(S.CLOSE),
        F.sum("usd").cast("double").alias(S.USD),
        F.sum("coins").cast("double").alias(S.COINS),
        F.coalesce(F.sum(F.when(buys, F.col("coins"))).cast("double"), F.lit(0.0)).alias(
            S.TAKER_BUY_COINS
        ),
        F.coalesce(F.sum(F.when(~buys, F.col("usd"))).cast("double"), F.lit(0.0)).alias(
            S.TAKER_SELL_USD
        ),
        F.count(F.lit(1)).alias(S.TRANSACTIONS),
    )
    number = F.col("bar_no")
    return bars.withColumns({"time_open": grid.start(number), "date": grid.part(number)}).select(
        *S.BARS.names
    )


def vwap(bars: DataFrame) -> DataFrame:
    """Add the average price of each bar."""
    return bars.withColumn(S.AVG, avg_price())


def scan_parts(
    bars: DataFrame,
    grid: Grid,
    back: int,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """The bars needed to rebuild parts ``first`` to ``last``: those parts and the one before.

    The bounds are literals on the partition column, so only those directories are read.
    """
    if first is not None:
        start = first - timedelta(days=grid.part_days) if back > 0 else first
        bars = bars.where(F.col("date") >= F.lit(start))
    if last is not None:
        bars = bars.where(F.col("date") <= F.lit(last))
    return bars


def by_part(
    bars: DataFrame,
    grid: Grid,
    back: int,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Give each part its own bars and the last ``back`` bars' time of the part before.

    Adds ``bar_no`` and ``part_name``. Work that looks at most ``back`` bars back can then run per
    (symbol, part_name) instead of per symbol: a group never exceeds one part and its lead-in, so one
    symbol with years of bars, or with most of the bars, spreads over as many tasks as it has parts.
    A bar is a part's own where ``date = part_name``.
    """
    if back > grid.bars_per_part:
        raise ValueError(f"cannot look back {back} bars: a part holds {grid.bars_per_part}")
    own = F.col("date")
    following = F.date_add(own, grid.part_days)
    spread = (
        scan_parts(bars, grid, back, first, last)
        .withColumn("bar_no", grid.number(F.col("time_open")))
        .withColumn(
            "part_name",
            F.explode(
                F.when(
                    grid.position(F.col("bar_no")) >= grid.bars_per_part - back,
                    F.array(own, following),
                ).otherwise(F.array(own))
            ),
        )
    )
    if first is not None:
        spread = spread.where(F.col("part_name") >= F.lit(first))
    if last is not None:
        spread = spread.where(F.col("part_name") <= F.lit(last))
    return spread


def part_window() -> WindowSpec:
    """The bars a part can see, in time order."""
    return Window.partitionBy("symbol", "part_name").orderBy("bar_no")


def full_lookback(lookback: int) -> Column:
    """Over ``part_window``: no bar is missing among the ``lookback`` before this one."""
    earlier = F.lag("bar_no", lookback).over(part_window())
    return F.coalesce(earlier == F.col("bar_no") - lookback, F.lit(False))


def has_full_lookback(bars: DataFrame, grid: Grid, lookback: int = 300) -> DataFrame:
    """Flag the bars whose ``lookback`` predecessors of the same symbol are all present."""
    return (
        by_part(bars, grid, lookback)
        .withColumn("is_full_lookback", full_lookback(lookback))
        .where(F.col("date") == F.col("part_name"))
        .select(*bars.columns, "is_full_lookback")
    )
