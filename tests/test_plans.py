"""What the plans must keep: few shuffles, pruned scans, bounded groups, no dependence on settings."""

import re
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture as X
from checks import queries as Q
from checks.compare import connect, differences
from checks.oracle import oracles
from tests.conftest import SF_DIR
from tidemark import schemas as S
from tidemark.operators import cases as C
from tidemark.operators.bars import bars_from_trades, by_part
from tidemark.operators.rows import lookup_any
from tidemark.operators.targets import targets
from tidemark.plans import training as P
from tidemark.sources.tables import read_table, replace_parts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(df))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    first, last = X.part_range(spark, SF_DIR)
    bars, found = str(folder / "bars"), str(folder / "targets")
    replace_parts(X.bars(spark, SF_DIR), bars, first, last, S.BARS, ["symbol", "time_open"], "date")
    built = Q.targets(spark, SF_DIR)
    replace_parts(built, found, first, last, S.TARGETS, S.TARGET_KEY)
    return read_table(spark, bars, S.BARS), read_table(spark, found, S.TARGETS)


def stored_targets(bars, **settings):
    return targets(
        bars, X.GRID, horizons=X.HORIZONS, lookback=X.LOOKBACK, bucket=Q.PART_BUCKET, **settings
    )


def test_targets_shuffle_once(stored):
    bars, _ = stored
    assert len(shuffles(stored_targets(bars))) == 1


def test_training_set_shuffles_bars_and_targets_once_each(stored):
    bars, found = stored
    built = P.training_set(found, bars, X.GRID, before=X.BEFORE, after=X.AFTER)
    keys = shuffles(built)
    assert len(keys) == 2
    assert all(re.fullmatch(r"symbol#\d+, part_name#\d+, 4", k) for k in keys), keys
    assert "Cartesian" not in plan(built) and "NestedLoop" not in plan(built)
    assert plan(built).count("Sort [") == 3  # both sides of the join, and cases once


def test_report_reads_and_shuffles_targets_and_bars_once(stored):
    bars, found = stored
    gains = P.case_gains(found, bars, X.GRID, after=X.AFTER)
    text = plan(gains)
    assert text.count("FileScan parquet") == 2 and len(shuffles(gains)) == 2
    assert "Window" not in text and text.count("Join") == 1
    expansion = text.index("Generate explode(transform")
    assert "Sort" not in text[:expansion] and "Exchange" not in text[:expansion]


def test_dense_rows_are_not_shuffled(stored):
    bars, found = stored
    text = plan(C.with_entry(C.dense_around(found, bars, X.GRID, X.BEFORE, X.AFTER)))
    expansion = text.index("Generate explode(transform")
    assert "Exchange" not in text[:expansion] and text.count("FileScan parquet") == 2


def test_probe_reads_the_parts_of_its_cases(spark, stored):
    bars, found = stored
    cases = found.orderBy("time_open", "symbol").limit(2).select("symbol", "time_open").collect()
    listed = spark.createDataFrame(cases, "symbol string, time_open timestamp_ntz")
    text = plan(P.feature_probe(found, bars, X.GRID, listed))
    scan = text[text.index("LeftSemi") :]
    assert "dynamicpruning" in scan.lower()


@pytest.fixture
def small_row_groups(spark):
    """Files of many row groups, and plans as they are made, so that scans can be asked what they read."""
    conf, adaptive = spark.sparkContext._jsc.hadoopConfiguration(), spark.conf.get("spark.sql.adaptive.enabled")
    conf.set("parquet.block.size", "1000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    conf.unset("parquet.block.size")


def rows_read(df, column):
    """The result, and how many rows the scans with this column have read."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    scans = [x for x in scans if "FileScan parquet" in x.toString() and column in x.schema().simpleString()]
    return rows, sum(x.metrics().get("numOutputRows").get().value() for x in scans)


def test_probe_reads_few_row_groups(spark, tmp_path, small_row_groups):
    """Of stored bars, a probe of two listed cases reads the row groups that may hold their symbols."""
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    first, last = X.part_range(spark, folder)
    path = str(tmp_path / "bars")
    replace_parts(X.bars(spark, folder), path, first, last, S.BARS, ["symbol", "time_open"], "date")
    groups = sum(pq.read_metadata(f).num_row_groups for f in tmp_path.rglob("*.parquet"))
    bars = read_table(spark, path, S.BARS)
    assert groups > bars.count() / 150
    found = spark.createDataFrame(stored_targets(bars).collect(), S.TARGETS)
    chosen = found.where("target_name = 'price_increase_1'").orderBy("time_open", "symbol").limit(2)
    cases = [tuple(r) for r in chosen.select("symbol", "time_open").collect()]
    rows, read = rows_read(P.feature_probe(found, bars, X.GRID, cases), S.COINS)
    frame = spark.createDataFrame(cases, "symbol string, time_open timestamp_ntz")
    assert sorted(rows) == sorted(P.feature_probe(found, bars, X.GRID, frame).collect())
    parts = {X.GRID.part_of(t) for _, t in cases} | {X.GRID.part_of(t) - timedelta(days=364) for _, t in cases}
    assert len(rows) == 2 and 0 < read <= bars.where(F.col("date").isin(sorted(parts))).count() / 4


def test_a_list_of_many_cases_is_looked_up(spark, stored, monkeypatch):
    bars, found = stored
    cases = [tuple(r) for r in found.select("symbol", "time_open").limit(30).collect()]
    whole = sorted(P.feature_probe(found, bars, X.GRID, cases).collect())
    monkeypatch.setattr(P, "LITERAL_CASES", 5)
    assert sorted(P.feature_probe(found, bars, X.GRID, cases).collect()) == whole


def test_parts_have_names_outside_of_frames(spark):
    times = [datetime(1990, 5, 6, 7), datetime(1995, 1, 2), datetime(2001, 12, 31, 23)]
    rows = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    named = rows.select(X.GRID.part(X.GRID.number(F.col("t")))).collect()
    assert [r[0] for r in named] == [X.GRID.part_of(t) for t in times]


def test_key_texts_have_bloom_filters(spark, tmp_path):
    symbol = F.md5(F.col("id").cast("string")).alias("symbol")
    rows = spark.range(40_000).select(symbol, F.lit(date(1996, 1, 1)).alias("date"))
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType())])
    replace_parts(rows, str(tmp_path / "t"), date(1996, 1, 1), date(1996, 1, 1), schema, ["symbol"], "date")
    hadoop = spark._jvm.org.apache.parquet.hadoop
    for file in (tmp_path / "t").rglob("*.parquet"):
        place = spark._jvm.org.apache.hadoop.fs.Path(str(file))
        opened = hadoop.util.HadoopInputFile.fromPath(place, spark.sparkContext._jsc.hadoopConfiguration())
        columns = hadoop.ParquetFileReader.open(opened).getFooter().getBlocks().get(0).getColumns()
        named = {columns.get(i).getPath().toDotString(): columns.get(i) for i in range(columns.size())}
        assert named["symbol"].getBloomFilterOffset() > 0


def test_fixture_bars_aggregate_by_hash(spark):
    assert "SortAggregate" not in plan(X.bars(spark, SF_DIR))


def test_one_part_reads_two_parts_of_bars(stored):
    bars, _ = stored
    part = date(1996, 12, 30)
    text = plan(stored_targets(bars, first=part, last=part))
    filters = re.search(r"PartitionFilters: \[([^\]]*)", text).group(1)
    assert "date" in filters and ">= 1996-01-01" in filters and "<= 1996-12-30" in filters
    columns = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {"symbol", "time_open", S.USD, S.COINS}


def test_training_set_reads_only_the_columns_it_uses(stored):
    bars, found = stored
    text = plan(P.training_set(found, bars, X.GRID, before=X.BEFORE, after=X.AFTER))
    read = {c.split(":")[0] for r in re.findall(r"ReadSchema: struct<([^>]*)", text) for c in r.split(",")}
    assert not read & {S.OPEN, S.CLOSE, S.TAKER_BUY_COINS, S.TAKER_SELL_USD, S.TRANSACTIONS}


def test_a_hot_key_of_a_lookup_is_split(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        numbers = spark.range(600_000)
        hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
        left = numbers.select(hot.alias("k"), F.xxhash64("id").alias("payload"))
        right = spark.range(10_000).select((F.col("id") % 5000).alias("k"), F.col("id").alias("v"))
        looked = lookup_any(left, right, ["k"], {"v": 0}).agg(F.sum("v"), F.max("payload"))
        total = looked.collect()[0][0]
        assert total == 200_000 * 5007 + sum(i % 5000 + 5000 for i in range(600_000) if i % 3)
        assert "skew=true" in plan(looked)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_days_are_pushed_into_the_scan(spark):
    text = plan(Q.yesterday(spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-15" in text and "LessThan(ts,2024-01-16" in text


def test_bars_aggregate_by_hash_with_one_trade_id(spark):
    trades = X.table(spark, SF_DIR, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    built = bars_from_trades(
        trades,
        X.GRID,
        symbol=F.col("l_suppkey"),
        ts=F.col("l_shipdate"),
        price=price,
        coins=F.col("l_quantity").cast("bigint"),
        usd=F.col("l_extendedprice").cast("decimal(18,2)"),
        taker_buys=F.col("l_returnflag") == "N",
        order=[F.col("l_orderkey")],
    )
    assert "SortAggregate" not in plan(built) and plan(built).count("HashAggregate") == 2


def test_no_group_exceeds_a_part_and_its_lead_in(spark):
    """Also with most trades in one symbol: what is grouped are bars, and they are unique."""
    trades = X.table(spark, SF_DIR, "lineitem")
    symbol = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_suppkey"))
    hot = trades.withColumn("l_suppkey", symbol)
    price = F.col("l_extendedprice") / F.col("l_quantity")
    bars = bars_from_trades(
        hot,
        X.GRID,
        symbol=F.col("l_suppkey"),
        ts=F.col("l_shipdate"),
        price=price,
        coins=F.col("l_quantity").cast("bigint"),
        usd=F.col("l_extendedprice").cast("decimal(18,2)"),
        taker_buys=F.col("l_returnflag") == "N",
        order=[F.col("l_orderkey")],
    )
    groups = by_part(bars, X.GRID, X.LOOKBACK).groupBy("symbol", "part_name").count()
    assert groups.agg(F.max("count")).first()[0] <= X.GRID.bars_per_part + X.LOOKBACK


def test_bars_may_hold_plain_timestamps(stored):
    bars, _ = stored
    zoned = bars.withColumn("time_open", F.col("time_open").cast("timestamp"))
    settings = dict(before=X.BEFORE, after=X.AFTER)
    built = [P.training_set(stored_targets(b), b, X.GRID, **settings) for b in (bars, zoned)]
    assert built[1].schema["target_timestamp"].dataType.simpleString() == "timestamp"
    plain = built[1].withColumn(
        "target_timestamp", F.col("target_timestamp").cast("timestamp_ntz")
    )
    assert not plain.isEmpty()
    assert plain.exceptAll(built[0]).isEmpty() and built[0].exceptAll(plain).isEmpty()


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    """The test tables with a third of all lines moved to one supplier, and half of those to one week."""
    folder = tmp_path_factory.mktemp("hot")
    lines = X.table(spark, SF_DIR, "lineitem")
    chance = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(6))
    week = F.lit("1996-05-06").cast("timestamp_ntz")
    moved = lines.withColumns(
        {
            "l_suppkey": F.when(chance < 2, F.lit(1).cast("bigint")).otherwise(F.col("l_suppkey")),
            "l_shipdate": F.when(chance < 1, week).otherwise(F.col("l_shipdate")),
        }
    )
    moved.write.parquet(str(folder / "lineitem.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["bars_from_trades", "targets", "training_set", "backtest_report"])
def test_hot_symbols_agree_with_sql(spark, hot_dir, name):
    duck = connect(SF_DIR)
    duck.execute(
        f"CREATE OR REPLACE VIEW lineitem AS FROM read_parquet('{hot_dir}/lineitem.parquet/*.parquet')"
    )
    assert differences(Q.queries()[name](spark, hot_dir), duck, oracles()[name]) == []


@pytest.mark.parametrize(
    "settings",
    [
        {"spark.sql.session.timeZone": "America/New_York"},
        {"spark.sql.ansi.enabled": "false"},
        {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "7"},
        {"spark.sql.autoBroadcastJoinThreshold": "-1"},
    ],
    ids=lambda s: next(iter(s)).split(".")[-2],
)
def test_results_do_not_depend_on_settings(spark, settings):
    duck, sql = connect(SF_DIR), oracles()
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for name in ("bars_from_trades", "targets", "training_set", "feature_probe", "backtest_report"):
            assert differences(Q.queries()[name](spark, SF_DIR), duck, sql[name]) == []
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
