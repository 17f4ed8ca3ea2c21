from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks import fixture as X
from checks import queries as Q
from tests.conftest import DAY
from tidemark import schemas as S
from tidemark.operators.rows import dedupe_max, first_per_bucket, latest_version, lookup_any
from tidemark.operators.rows import days_before, yesterday
from tidemark.operators.targets import growth, growth_all, targets


def steady(last_prices, start=-300):
    """300 bars at 100, then the given prices."""
    flat = [("A", start + m, 100.0) for m in range(300)]
    return flat + [("A", start + 300 + i, p) for i, p in enumerate(last_prices)]


def at(df, minute, column):
    rows = df.where(F.col("time_open") == F.lit(DAY + timedelta(minutes=minute))).collect()
    return [r[column] for r in rows]


def test_growth(make_bars, grid):
    grown = growth(make_bars(steady([102.0, 102.0])), grid, 1, 1)
    assert at(grown, 0, "growth") == [1.02]
    assert at(grown, 1, "growth") == [1.0]
    assert at(grown, -1, "growth") == [None]


def test_growth_over_several_rows(make_bars, grid):
    grown = growth(make_bars(steady([104.0, 108.0])), grid, 1, 2)
    assert at(grown, 1, "growth") == [1.058]  # 108 / 102 = 1.0588


def test_growth_without_volume(make_bars, grid):
    nothing = [("A", 0, 0.0, 0.0, 0.0, 0.0), ("A", 1, 102.0)]
    grown = growth(make_bars(steady([]) + nothing), grid, 1, 1)
    assert at(grown, 0, "growth") == [None]  # 0/0 over 100
    assert at(grown, 1, "growth") == [None]  # 102 over 0/0


def test_growth_over_an_infinite_price_is_zero(make_bars, grid):
    bars = make_bars(steady([100.0, 102.0]))
    bars = bars.withColumn(
        S.COINS,
        F.when(F.col("time_open") == F.lit(DAY), F.lit(0.0)).otherwise(F.col(S.COINS)),
    )
    grown = growth(bars, grid, 1, 1)
    assert at(grown, 0, "growth") == [None]
    assert at(grown, 1, "growth") == [0.0]


def test_frames_must_lie_within_the_lookback(make_bars, grid):
    with pytest.raises(ValueError):
        growth(make_bars(steady([])), grid, 1, 301)


def test_growth_all_is_growth_per_horizon(spark, sf_dir):
    bars = X.bars(spark, sf_dir)
    every = growth_all(bars, X.GRID, X.HORIZONS, X.LOOKBACK)
    for k in X.HORIZONS:
        one = growth(bars, X.GRID, k, k, X.LOOKBACK).select("symbol", "time_open", "growth")
        mine = every.where(F.col("target_name") == f"price_increase_{k}")
        mine = mine.select("symbol", "time_open", F.col("value").alias("growth"))
        assert one.exceptAll(mine).isEmpty() and mine.exceptAll(one).isEmpty()


def test_threshold_before_the_lookup_of_growth_loses_nothing(spark, sf_dir):
    bars = X.bars(spark, sf_dir)
    for least in (0.5, 1.0, 1.01, 3.0):
        kept = growth_all(bars, X.GRID, X.HORIZONS, X.LOOKBACK, at_least=least)
        whole = growth_all(bars, X.GRID, X.HORIZONS, X.LOOKBACK).where(F.col("value") >= least)
        assert kept.exceptAll(whole).isEmpty() and whole.exceptAll(kept).isEmpty()


def test_targets_threshold_and_type(make_bars, grid):
    found = targets(make_bars(steady([101.0])), grid, horizons=[1])
    assert [(r["time_open"], r["value"]) for r in found.collect()] == [
        (DAY, pytest.approx(1.01, abs=1e-6))
    ]
    assert found.schema["value"].dataType.simpleString() == "float"
    assert targets(make_bars(steady([100.9999])), grid, horizons=[1]).isEmpty()


def test_targets_are_one_per_ten_minutes(make_bars, grid):
    prices = [102.0, 104.1] + [104.1] * 7 + [107.0, 109.5]
    found = targets(make_bars(steady(prices)), grid, horizons=[1])
    assert [r["time_open"] for r in found.orderBy("time_open").collect()] == [
        DAY,
        DAY + timedelta(minutes=10),
    ]


def test_targets_of_a_part_look_back_into_the_part_before(make_bars, grid):
    bars = make_bars(steady([102.0]) + [("A", m, 102.0) for m in range(1, 5)])
    day = DAY.date()
    assert targets(bars, grid, day, day, [1]).count() == 1
    before = day - timedelta(days=1)
    assert targets(bars, grid, before, before, [1]).isEmpty()


def test_targets_by_part_equal_one_pass(spark, sf_dir):
    bars = X.bars(spark, sf_dir)
    settings = dict(horizons=X.HORIZONS, lookback=X.LOOKBACK, bucket=Q.PART_BUCKET)
    whole = targets(bars, X.GRID, **settings)
    parts = [r["date"] for r in bars.select("date").distinct().collect()]
    assert len(parts) > 5
    pieces = None
    for part in parts:
        piece = targets(bars, X.GRID, part, part, **settings)
        pieces = piece if pieces is None else pieces.unionByName(piece)
    assert pieces.exceptAll(whole).isEmpty() and whole.exceptAll(pieces).isEmpty()


@pytest.mark.parametrize("bucket", [10, 7, 52])
def test_straddling_buckets_by_part_equal_one_pass(spark, sf_dir, bucket):
    """Parts of 52 bars, whose last bucket goes on in the next part."""
    bars = X.bars(spark, sf_dir).cache()
    settings = dict(horizons=[1, 3], lookback=X.LOOKBACK, bucket=bucket)
    whole = targets(bars, X.GRID, **settings)
    parts = sorted(r["date"] for r in bars.select("date").distinct().collect())
    pieces = None
    for at in range(0, len(parts), 2):
        piece = targets(bars, X.GRID, parts[at], parts[min(at + 1, len(parts) - 1)], **settings)
        pieces = piece if pieces is None else pieces.unionByName(piece)
    assert not whole.isEmpty()
    assert pieces.exceptAll(whole).isEmpty() and whole.exceptAll(pieces).isEmpty()


def test_buckets_are_no_longer_than_parts(spark, sf_dir):
    with pytest.raises(ValueError):
        targets(X.bars(spark, sf_dir), X.GRID, lookback=10, horizons=[1], bucket=53)


def test_dedupe_max(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "k string, v double")
    assert sorted(map(tuple, dedupe_max(df, ["k"], "v").collect())) == [("a", 3.0), ("b", 2.0)]


def test_first_per_bucket(make_bars, grid):
    bars = make_bars([("A", m, 1.0) for m in (9, 1, 10)])
    kept = first_per_bucket(bars, grid, ["symbol"], "time_open")
    assert kept.columns == bars.columns
    assert sorted(r["time_open"].minute for r in kept.collect()) == [1, 10]


def test_lookup_any(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 5.0), (1, 7.0)], "k int, v double")
    found = lookup_any(left, right, ["k"], {"v": 0.0}).orderBy("k")
    assert [tuple(r) for r in found.collect()] == [(1, 7.0), (2, 0.0)]


def test_latest_version(spark):
    rows = [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")]
    df = spark.createDataFrame(rows, "k string, version int, text string")
    newest = latest_version(df, ["k"], ["version"])
    assert sorted(map(tuple, newest.collect())) == [("a", 2, "new"), ("b", 1, "only")]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_days_before(spark, kind):
    texts = ["2023-02-01 23:59:59", "2023-02-02 00:00:00", "2023-02-02 23:59:59", "2023-02-03 00:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.withColumn("day", F.col("t").cast("timestamp_ntz").cast(kind))
    assert yesterday(df, "day", date(2023, 2, 3)).count() == 2
    assert days_before(df, "day", date(2023, 2, 3), 2).count() == 3
