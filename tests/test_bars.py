from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import fixture as X
from tests.conftest import DAY
from tidemark import Grid
from tidemark import schemas as S
from tidemark.operators.bars import (
    bars_from_trades,
    by_part,
    has_full_lookback,
    merged_bars,
    partial_bars,
    vwap,
)


def trades(spark):
    rows = [
        (1, "A", DAY + timedelta(seconds=5), 10.0, 2, True),
        (2, "A", DAY + timedelta(seconds=50), 12.0, 1, False),
        (3, "A", DAY + timedelta(seconds=59), 11.0, 1, True),
        (4, "A", DAY + timedelta(seconds=60), 9.0, 4, False),
        (5, "B", DAY + timedelta(seconds=60), 7.0, 3, False),
    ]
    return spark.createDataFrame(
        rows, "id bigint, symbol string, ts timestamp_ntz, price double, qty bigint, buy boolean"
    )


def build(spark, order):
    return bars_from_trades(
        trades(spark),
        Grid(),
        symbol=F.col("symbol"),
        ts=F.col("ts"),
        price=F.col("price"),
        coins=F.col("qty"),
        usd=(F.col("price") * F.col("qty")).cast("decimal(18,2)"),
        taker_buys=F.col("buy"),
        order=[F.col(c) for c in order],
    )


@pytest.mark.parametrize("order", [["id"], ["ts", "id"]])
def test_bars_from_trades(spark, order):
    rows = build(spark, order).orderBy("symbol", "time_open").collect()
    assert [tuple(r) for r in rows] == [
        ("A", DAY, DAY.date(), 10.0, 12.0, 10.0, 11.0, 43.0, 4.0, 3.0, 12.0, 3),
        ("A", DAY + timedelta(minutes=1), DAY.date(), 9.0, 9.0, 9.0, 9.0, 36.0, 4.0, 0.0, 36.0, 1),
        ("B", DAY + timedelta(minutes=1), DAY.date(), 7.0, 7.0, 7.0, 7.0, 21.0, 3.0, 0.0, 21.0, 1),
    ]


def test_bars_have_the_declared_schema(spark):
    assert [(f.name, f.dataType) for f in build(spark, ["id"]).schema] == [
        (f.name, f.dataType) for f in S.BARS
    ]


def test_vwap(spark):
    bars = spark.createDataFrame([(10.0, 4.0), (0.0, 4.0), (10.0, 0.0)], [S.USD, S.COINS])
    assert [r[S.AVG] for r in vwap(bars).collect()] == [2.5, 0.0, 0.0]


def full(bars, grid):
    flagged = has_full_lookback(bars, grid).orderBy("symbol", "time_open").collect()
    return [r["is_full_lookback"] for r in flagged]


def test_full_lookback_needs_every_bar(make_bars, grid):
    minutes = [("A", m, 1.0) for m in range(301)]
    assert full(make_bars(minutes), grid) == [False] * 300 + [True]
    assert full(make_bars(minutes[:150] + minutes[151:]), grid) == [False] * 300


def test_full_lookback_reaches_across_midnight_but_not_across_symbols(make_bars, grid):
    rows = [("A", m, 1.0) for m in range(-200, 101)] + [("B", m, 1.0) for m in range(101, 300)]
    assert full(make_bars(rows), grid) == [False] * 300 + [True] + [False] * 199


def test_lookback_is_at_most_a_part(make_bars, grid):
    with pytest.raises(ValueError):
        by_part(make_bars([("A", 0, 1.0)]), grid, 1441)


def test_by_part_leads_in_with_the_end_of_the_part_before(make_bars, grid):
    bars = make_bars([("A", m, 1.0) for m in range(-3, 2)])
    seen = by_part(bars, grid, 2).groupBy("part_name").count().orderBy("part_name").collect()
    assert [r["count"] for r in seen] == [3, 4]


def test_grid_numbers_and_parts(spark):
    week = Grid(bar=timedelta(days=7), origin=datetime(1995, 1, 2), part_days=364)
    assert week.bars_per_part == 52
    times = [datetime(1995, 1, 8, 23, 59), datetime(1996, 1, 1), datetime(1995, 1, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    number = week.number(F.col("t"))
    got = df.select(number, week.start(number), week.part(number), week.position(number)).collect()
    assert [tuple(r) for r in got] == [
        (0, datetime(1995, 1, 2), datetime(1995, 1, 2).date(), 0),
        (52, datetime(1996, 1, 1), datetime(1996, 1, 1).date(), 0),
        (-1, datetime(1994, 12, 26), datetime(1994, 1, 3).date(), 51),
    ]


def test_grid_needs_whole_bars_per_part():
    with pytest.raises(ValueError):
        Grid(bar=timedelta(minutes=7))
    with pytest.raises(ValueError):
        Grid(origin=datetime(2020, 1, 1, 1))


def trade_columns():
    return dict(
        symbol=F.col("l_suppkey"),
        ts=F.col("l_shipdate"),
        price=F.col("l_extendedprice") / F.col("l_quantity"),
        coins=F.col("l_quantity").cast("bigint"),
        usd=F.col("l_extendedprice").cast("decimal(18,2)"),
        taker_buys=F.col("l_returnflag") == "N",
    )


@pytest.mark.parametrize("order", [["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], None])
def test_bars_of_several_loads_equal_bars_of_one(spark, sf_dir, tmp_path, order):
    """Late trades are stored beside the earlier ones; the bars are those of all trades, bit for bit."""
    trades = X.table(spark, sf_dir, "lineitem")
    rank = [F.col(c) for c in order] if order else [X.trade_rank()]
    load = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3))
    for k in range(3):
        partial = partial_bars(trades.where(load == k), X.GRID, **trade_columns(), order=rank)
        partial.write.mode("append").partitionBy("date").parquet(str(tmp_path / "partial"))
    held = spark.read.parquet(str(tmp_path / "partial"))
    merged = merged_bars(held, X.GRID)
    whole = bars_from_trades(trades, X.GRID, **trade_columns(), order=rank)
    assert merged.schema.simpleString() == whole.schema.simpleString()
    assert held.count() > whole.count() > 0
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()


def test_bars_without_buys_or_sells(spark, sf_dir):
    trades = X.table(spark, sf_dir, "lineitem").limit(50)
    for flag in (True, False):
        columns = trade_columns() | {"taker_buys": F.lit(flag)}
        merged = merged_bars(partial_bars(trades, X.GRID, **columns, order=[X.trade_rank()]), X.GRID)
        whole = bars_from_trades(trades, X.GRID, **columns, order=[X.trade_rank()])
        assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()
