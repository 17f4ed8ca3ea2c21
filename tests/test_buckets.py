"""Bucketed tables: the same rows as plain ones, without shuffles, and safe against wrong layouts."""

from datetime import timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import fixture as X
from checks import queries as Q
from tests.conftest import SF_DIR
from tests.test_plans import plan, shuffles
from tidemark import schemas as S
from tidemark.operators import cases as C
from tidemark.operators.rows import latest_version
from tidemark.plans import training as P
from tidemark.plans.backfill import load_bars, refresh, refresh_changed
from tidemark.sources.buckets import ALL_KEYS, BucketedTable, joining_in_place
from tidemark.sources.tables import read_table, replace_parts

CASE = {"before": X.BEFORE, "after": X.AFTER}
LENGTH = timedelta(days=X.GRID.part_days)


def sorted_rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Bars and targets in 4 buckets a part."""
    folder = tmp_path_factory.mktemp("bucketed")
    first, last = X.part_range(spark, SF_DIR)
    bars = BucketedTable(str(folder / "bars"), S.BARS, 4, "date")
    found = BucketedTable(str(folder / "targets"), S.TARGETS, 4)
    bars.replace(X.bars(spark, SF_DIR), first, last)
    found.replace(Q.targets(spark, SF_DIR), first, last)
    return bars, found


@pytest.fixture(scope="module")
def in_place(spark, tables):
    """Both tables, read to be joined as they lie."""
    session = joining_in_place(spark)
    return [t.read(session) for t in tables]


def test_rows_come_back(spark, tables):
    bars, found = tables
    assert sorted_rows(bars.read(spark)) == sorted_rows(X.bars(spark, SF_DIR))
    assert sorted_rows(found.read(spark)) == sorted_rows(Q.targets(spark, SF_DIR))
    assert sorted_rows(read_table(spark, bars.path, S.BARS)) == sorted_rows(bars.read(spark))


def below_results(df):
    """The plan but for lookups of the parts that a scan can skip."""
    text = plan(df)
    return text[: text.index("Subqueries")] if "Subqueries" in text else text


def test_training_set_shuffles_nothing(spark, in_place):
    found, bars = in_place[1], in_place[0]
    built = P.training_set(found, bars, X.GRID, in_place=True, **CASE)
    text = below_results(built)
    assert "Exchange" not in text and "SortMergeJoin" in text and text.count("Bucketed: true") == 2
    assert shuffles(P.training_set(found, bars, X.GRID, **CASE))
    plain = P.training_set(Q.targets(spark, SF_DIR), X.bars(spark, SF_DIR), X.GRID, **CASE)
    assert sorted_rows(built) == sorted_rows(plain)


def test_case_rows_and_gains_shuffle_nothing_below_their_results(in_place):
    bars, found = in_place
    rows = C.case_rows(found, bars, X.GRID, in_place=True, **CASE)
    assert "Exchange" not in below_results(rows)
    assert sorted_rows(rows) == sorted_rows(C.case_rows(found, bars, X.GRID, **CASE))
    gains = P.case_gains(found, bars, X.GRID, after=X.AFTER, in_place=True)
    assert "Exchange" not in below_results(gains)
    report = P.backtest_report(found, bars, X.GRID, after=X.AFTER, in_place=True)
    assert all("target_name" in k and "symbol" not in k for k in shuffles(report))
    assert report.collect() == P.backtest_report(found, bars, X.GRID, after=X.AFTER).collect()
    dense = C.dense_around(found, bars, X.GRID, X.BEFORE, X.AFTER, in_place=True)
    assert "Exchange" not in below_results(dense)
    assert sorted_rows(dense) == sorted_rows(C.dense_around(found, bars, X.GRID, X.BEFORE, X.AFTER))


def test_targets_are_found_in_place(spark, tables):
    bars = tables[0].read(spark)
    built = Q.G.targets(bars, X.GRID, horizons=X.HORIZONS, lookback=X.LOOKBACK, bucket=Q.PART_BUCKET)
    assert "Exchange" not in plan(built)


def test_one_file_for_each_bucket_of_a_part(tables):
    from pathlib import Path

    for part in Path(tables[0].path).glob("date=*"):
        assert len(list(part.glob("*.parquet"))) <= 4
        for f in part.glob("*.parquet"):
            assert "date" not in pq.read_schema(f).names


def test_newest_versions_without_a_shuffle(spark, tmp_path, tables):
    copies = BucketedTable(str(tmp_path / "versions"), S.TARGETS, 3)
    found = tables[1].read(spark)
    copies.append(found)
    changed = found.where("symbol < '5'").withColumn("value", F.lit(9.0).cast("float"))
    copies.append(changed)
    newest = latest_version(copies.read(spark, version=True), S.TARGET_KEY, [S.VERSION.name])
    assert "Exchange" not in plan(newest)
    expected = changed.unionAll(found.where("not symbol < '5'"))
    assert copies.read(spark).count() == found.count() + changed.count()
    assert sorted_rows(newest.drop(S.VERSION.name)) == sorted_rows(expected)


def test_parts_are_replaced_emptied_and_left(spark, tmp_path, tables):
    first, last = X.part_range(spark, SF_DIR)
    table = BucketedTable(str(tmp_path / "parts"), S.TARGETS, 3)
    found = tables[1].read(spark)
    table.replace(found, first, last)
    second = first + LENGTH
    spoilt = found.withColumn("value", F.lit(0.0).cast("float"))
    table.replace(spoilt.where(F.col("part_name") == F.lit(first)), first, second)
    rows = table.read(spark)
    assert rows.where((F.col("part_name") == F.lit(first)) & (F.col("value") != 0)).count() == 0
    assert rows.where(F.col("part_name") == F.lit(first)).count() > 0
    assert rows.where(F.col("part_name") == F.lit(second)).count() == 0
    later = F.col("part_name") > F.lit(second)
    assert sorted_rows(rows.where(later)) == sorted_rows(found.where(later))
    held = sorted_rows(rows)
    table.replace(rows, first, last)  # of itself
    assert sorted_rows(table.read(spark)) == held


def test_rows_without_a_symbol_and_empty_tables(spark, tmp_path, tables):
    first, last = X.part_range(spark, SF_DIR)
    table = BucketedTable(str(tmp_path / "odd"), S.TARGETS, 3)
    table.replace(spark.createDataFrame([], S.TARGETS), first, last)
    assert table.read(spark).count() == 0
    unnamed = tables[1].read(spark).limit(5).withColumn("symbol", F.lit(None).cast("string"))
    table.replace(unnamed, first, last)
    assert table.read(spark).where("symbol IS NULL").count() == 5


def test_the_session_keeps_its_settings(spark, in_place):
    assert spark.conf.get(ALL_KEYS) == "true" and in_place[0].sparkSession.conf.get(ALL_KEYS) == "false"


def test_another_session_reads_what_the_folder_holds(spark, tables):
    other = spark.newSession()
    other.sql(f"DROP TABLE {tables[1].name}")
    assert sorted_rows(tables[1].read(other)) == sorted_rows(tables[1].read(spark))


def test_a_wrong_layout_is_refused(spark, tmp_path, tables):
    with pytest.raises(ValueError, match="bucketed by symbol 4"):
        BucketedTable(tables[1].path, S.TARGETS, 8).read(spark)
    first, last = X.part_range(spark, SF_DIR)
    plain = str(tmp_path / "it's plain")
    replace_parts(tables[1].read(spark), plain, first, last, S.TARGETS, S.TARGET_KEY)
    with pytest.raises(ValueError, match="not bucketed"):
        BucketedTable(plain, S.TARGETS, 4).read(spark)
    quoted = BucketedTable(str(tmp_path / "it's bucketed"), S.TARGETS, 4)
    quoted.replace(tables[1].read(spark), first, last)
    assert quoted.read(spark).count() == tables[1].read(spark).count()


def test_refresh_of_bucketed_tables(spark):
    from dataclasses import replace

    first, last = X.part_range(spark, SF_DIR)
    plain = Q.part_tables(spark)
    bucketed = replace(Q.part_tables(spark), buckets=3)
    bucketed = replace(bucketed, digests=f"{bucketed.bars}_digests")
    bars = X.bars(spark, SF_DIR)
    for t in (plain, bucketed):
        load_bars(bars, t, first, last)
    refresh(spark, plain, first, last)
    refresh_changed(spark, bucketed, first, last)
    late = bars.where("symbol <> '3' or closing_price_in_usd > 30")
    for t in (plain, bucketed):
        load_bars(late, t, first, first + LENGTH)
    refresh(spark, plain, first, last)
    refresh_changed(spark, bucketed, first, last)
    assert sorted_rows(bucketed.read_targets(spark)) == sorted_rows(plain.read_targets(spark))
    built = (read_table(spark, t.training, S.TRAINING) for t in (plain, bucketed))
    assert len({tuple(sorted_rows(b)) for b in built}) == 1
    refresh(spark, bucketed, first, last, parts_per_job=3)
    assert sorted_rows(bucketed.read_targets(spark)) == sorted_rows(plain.read_targets(spark))
