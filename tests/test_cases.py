from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from checks import fixture as X
from checks import queries as Q
from tests.conftest import DAY
from tidemark import schemas as S
from tidemark.operators.cases import (
    around,
    case_grid,
    case_rows,
    dense_around,
    entry_price,
    moments,
    per_target,
    traded,
)


def phases(df):
    counted = df.groupBy("interval_id").count().collect()
    return {r["interval_id"]: r["count"] for r in counted}


def test_case_grid(make_targets, grid):
    rows = case_grid(make_targets([("price_increase_1", "A", 600)]), grid)
    assert phases(rows) == {-1: 239, 0: 1, 1: 1, 2: 59}
    first, last = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    at = DAY + timedelta(minutes=600)
    assert (first, last) == (at - timedelta(minutes=239), at + timedelta(minutes=60))


def test_short_case_grid(make_targets, grid):
    rows = case_grid(make_targets([("price_increase_1", "A", 600)]), grid, 6, 3)
    assert phases(rows) == {-1: 6, 0: 1, 1: 1, 2: 2}


def test_entry_price(make_bars, grid):
    row = entry_price(make_bars([("A", 1, 100.0)]), grid).first()
    assert tuple(row) == ("A", DAY, 100.0 * 1.001)


def test_case_rows_hold_the_entry_price_of_the_join(spark, sf_dir):
    rows = Q.case_rows(spark, sf_dir)
    joined = rows.join(
        entry_price(X.bars(spark, sf_dir), X.GRID).withColumnRenamed("price_in", "other"),
        ["symbol", "target_timestamp"],
        "left",
    )
    assert joined.where(~F.col("price_in").eqNullSafe(F.col("other"))).isEmpty()
    assert rows.count() > 1000


def test_case_rows_reach_back_a_day_but_not_past_midnight(make_bars, make_targets, grid):
    bars = make_bars([("A", m, 100.0) for m in range(-300, 1500)])
    found = make_targets([("price_increase_1", "A", 5), ("price_increase_2", "A", 1400)])
    rows = case_rows(found, bars, grid)
    early = rows.where(F.col("target_name") == "price_increase_1")
    late = rows.where(F.col("target_name") == "price_increase_2")
    assert phases(early) == {-1: 239, 0: 1, 1: 1, 2: 59}
    assert phases(late) == {-1: 239, 0: 1, 1: 1, 2: 38}


def test_the_last_minute_of_a_part_has_no_entry(make_bars, make_targets, grid):
    bars = make_bars([("A", m, 100.0) for m in range(1300, 1500)])
    assert case_rows(make_targets([("price_increase_1", "A", 1439)]), bars, grid).isEmpty()


def test_untraded_bars_and_other_names_are_left_out(make_bars, make_targets, grid):
    bars = make_bars(
        [("A", m, 100.0) for m in range(5)] + [("A", 5, 100.0, 100.0, 100.0, 0.0)]
    )
    found = make_targets([("price_increase_1", "A", 2), ("price_increase_4", "A", 2)])
    rows = case_rows(found, bars, grid)
    assert {r["target_name"] for r in rows.collect()} == {"price_increase_1"}
    assert rows.count() == 5


def test_a_case_across_the_edges_of_stretches(make_bars, make_targets, grid):
    bars = make_bars([("A", m, 100.0) for m in range(0, 1440)])
    found = make_targets([("price_increase_1", "A", m) for m in range(300, 1380, 7)])
    rows = around(found, bars, grid, 239, 60)
    sizes = rows.groupBy("target_timestamp").count().select("count").distinct().collect()
    assert [r["count"] for r in sizes] == [300]


def test_dense_rows_are_zero_where_bars_are_missing(make_bars, make_targets, grid):
    bars = make_bars([("A", m, 100.0) for m in (599, 600, 602)])
    rows = dense_around(make_targets([("price_increase_1", "A", 600)]), bars, grid, 2, 2)
    prices = [r[S.AVG] for r in rows.orderBy("offset").collect()]
    assert prices == [0.0, 100.0, 100.0, 0.0, 100.0]


def test_dense_rows_and_rows_of_existing_bars_agree(spark, sf_dir):
    found, bars = Q.targets(spark, sf_dir), X.bars(spark, sf_dir)
    named = found.withColumnRenamed("value", "target_value")
    some = around(named, traded(bars), X.GRID, X.BEFORE, X.AFTER)
    every = dense_around(found, bars, X.GRID, X.BEFORE, X.AFTER).where(F.col(S.AVG) != 0)
    columns = ["symbol", "target_name", "target_timestamp", "timestamp", "offset", S.LOW, S.AVG]
    some, every = some.select(*columns), every.select(*columns)
    assert some.exceptAll(every).isEmpty() and every.exceptAll(some).isEmpty()


def test_moments_and_back(make_targets, spark):
    names = ["price_increase_1", "price_increase_2"]
    found = make_targets([(names[0], "A", 1, 1.25), (names[1], "A", 1, 1.5), (names[0], "B", 1, 2.0)])
    once = moments(found, names)
    assert once.count() == 2
    back = per_target(once, names).select("target_name", "symbol", "target_value")
    assert sorted(map(tuple, back.collect())) == [
        (names[0], "A", 1.25),
        (names[0], "B", 2.0),
        (names[1], "A", 1.5),
    ]


def test_a_case_must_fit_the_parts_it_sees(make_bars, make_targets, grid):
    with pytest.raises(ValueError):
        case_rows(make_targets([]), make_bars([]), grid, before=1441)
