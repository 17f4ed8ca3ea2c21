"""One query per operator, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture as X
from tidemark import schemas as S
from tidemark.operators import bars as B
from tidemark.operators import cases as C
from tidemark.operators import features as E
from tidemark.operators import rows as R
from tidemark.operators import targets as G
from tidemark.plans import training as P
from tidemark.plans.backfill import Tables, backfill, load_bars, refresh
from tidemark.sources.buckets import BucketedTable
from tidemark.sources.tables import read_table, replace_parts, truncate
from tidemark.sources.tsv import read_tsv, write_tsv
from tidemark.streaming.arrivals import process_new_bars

Query = Callable[[SparkSession, str], DataFrame]

PART_BUCKET = 13  # whole buckets per part, so that parts can be rebuilt alone
BUCKETS = 8  # of each part of a bucketed table
AS_OF = date(2024, 1, 16)
CASE = ["symbol", "part_name", "target_timestamp", "target_name", "target_value"]


def bars_from_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.bars(spark, sf_dir)


def vwap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.vwap(X.bars(spark, sf_dir)).select("symbol", "time_open", S.AVG)


def has_full_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = X.bars(spark, sf_dir).select("symbol", "time_open", "date")
    return B.has_full_lookback(bars, X.GRID, X.LOOKBACK).drop("date")


def growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = G.growth(X.bars(spark, sf_dir), X.GRID, 2, 5, X.LOOKBACK)
    return grown.select("symbol", "time_open", "growth")


def growth_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.growth_all(X.bars(spark, sf_dir), X.GRID, X.HORIZONS, X.LOOKBACK)


def dedupe_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    growths = growth_all(spark, sf_dir).drop("time_open")
    return R.dedupe_max(growths, ["symbol", "part_name", "target_name"], "value")


def first_per_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.first_per_bucket(X.bars(spark, sf_dir), X.GRID, ["symbol"], "time_open", X.BUCKET)


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.targets(
        X.bars(spark, sf_dir),
        X.GRID,
        horizons=X.HORIZONS,
        lookback=X.LOOKBACK,
        bucket=X.BUCKET,
    )


def targets_of_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets against the average price of one and of several earlier bars."""
    horizons = [1, (2, 5), (3, 10)]
    return G.targets(
        X.bars(spark, sf_dir), X.GRID, horizons=horizons, lookback=X.LOOKBACK, bucket=X.BUCKET
    )


def case_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.case_grid(targets(spark, sf_dir), X.GRID, X.BEFORE, X.AFTER)


def lookup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = X.bars(spark, sf_dir).withColumnRenamed("time_open", "timestamp")
    defaults = {S.CLOSE: 0.0, S.USD: 0.0, S.TRANSACTIONS: 0}
    return R.lookup_any(
        case_grid(spark, sf_dir),
        bars,
        ["symbol", "timestamp"],
        defaults,
    )


def entry_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.entry_price(X.bars(spark, sf_dir), X.GRID)


def case_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.case_rows(
        targets(spark, sf_dir), X.bars(spark, sf_dir), X.GRID, before=X.BEFORE, after=X.AFTER
    )


def dense_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case rows with a row of zeros for each missing bar and 0 for a missing entry price."""
    return C.with_entry(
        C.dense_around(
            targets(spark, sf_dir), X.bars(spark, sf_dir), X.GRID, X.BEFORE, X.AFTER
        )
    )


def step_change_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.step_change_pct(case_rows(spark, sf_dir), "asc").select(*CASE, "timestamp", S.STEP)


def step_change_pct_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.step_change_pct(dense_rows(spark, sf_dir), "desc").select(*CASE, "timestamp", S.STEP)


def phase_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.phase_sums(E.step_change_pct(case_rows(spark, sf_dir), "asc"))


def first_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.first_outcome(
        case_rows(spark, sf_dir), stop_ratio=X.STOP_RATIO, profit_ratio=X.PROFIT_RATIO
    )


def first_outcome_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.first_outcome(
        dense_rows(spark, sf_dir),
        order="desc",
        exit_price=S.LOW,
        stop_ratio=X.STOP_RATIO,
        profit_ratio=X.PROFIT_RATIO,
    )


def best_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.best_exit(case_rows(spark, sf_dir))


def liquid_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.liquid_cases(case_rows(spark, sf_dir))


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.training_set(
        targets(spark, sf_dir),
        X.bars(spark, sf_dir),
        X.GRID,
        before=X.BEFORE,
        after=X.AFTER,
        stop_ratio=X.STOP_RATIO,
        profit_ratio=X.PROFIT_RATIO,
    )


def feature_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe the last target of each symbol and part, where it is of the probed name."""
    found = targets(spark, sf_dir)
    listed = found.groupBy("symbol", "part_name").agg(F.max("time_open").alias("time_open"))
    cases = listed.select("symbol", "time_open")
    return P.feature_probe(found, X.bars(spark, sf_dir), X.GRID, cases, stored=False)


def backtest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.backtest_report(
        targets(spark, sf_dir),
        X.bars(spark, sf_dir),
        X.GRID,
        after=X.AFTER,
        stop_ratio=X.STOP_RATIO,
        profit_ratio=X.PROFIT_RATIO,
    )


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = X.table(spark, sf_dir, "events")
    return R.latest_version(events, ["user_id", "event_type"], ["ts", "event_id"])


def yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.yesterday(X.table(spark, sf_dir, "events"), "ts", AS_OF)


def days_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.days_before(X.table(spark, sf_dir, "events"), "ts", AS_OF, 2)


def scratch(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder, or below the warehouse where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def part_tables(spark: SparkSession) -> Tables:
    folder = scratch(spark)
    return Tables(
        bars=f"{folder}/bars",
        targets=f"{folder}/targets",
        training=f"{folder}/training",
        grid=X.GRID,
        target_settings=(
            ("horizons", X.HORIZONS),
            ("lookback", X.LOOKBACK),
            ("bucket", PART_BUCKET),
        ),
        training_settings=(
            ("before", X.BEFORE),
            ("after", X.AFTER),
            ("stop_ratio", X.STOP_RATIO),
            ("profit_ratio", X.PROFIT_RATIO),
        ),
    )


def replace_parts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all parts of the targets, spoil two of them and add one, and replace those three."""
    tables = part_tables(spark)
    length = timedelta(days=X.GRID.part_days)
    first, last = X.part_range(spark, sf_dir)
    load_bars(X.bars(spark, sf_dir), tables, first, last)
    built = tables.build_targets(spark, first, last)
    replace_parts(built, tables.targets, first, last, S.TARGETS, S.TARGET_KEY)
    second, third, beyond = first + length, first + 2 * length, last + length
    spoilt = tables.read_targets(spark).withColumn("value", F.lit(0.0).cast("float"))
    spoilt_copy = replace(tables, targets=f"{tables.targets}_spoilt")
    spoilt.write.parquet(spoilt_copy.targets)
    wrong = spark.read.schema(S.TARGETS).parquet(spoilt_copy.targets)
    replace_parts(
        wrong.where(F.col("part_name") == F.lit(second)),
        tables.targets, second, third, S.TARGETS, S.TARGET_KEY,
    )
    again = tables.build_targets(spark, second, third)
    replace_parts(again, tables.targets, second, third, S.TARGETS, S.TARGET_KEY)
    moved = wrong.withColumn("part_name", F.lit(beyond))
    replace_parts(moved, tables.targets, beyond, beyond, S.TARGETS, S.TARGET_KEY)
    emptied = tables.build_targets(spark, beyond + length, beyond + length)
    replace_parts(emptied, tables.targets, beyond, beyond, S.TARGETS, S.TARGET_KEY)
    return tables.read_targets(spark)


def backfill_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three tables, built and stored run by run."""
    tables = part_tables(spark)
    bars = X.bars(spark, sf_dir)
    first, last = X.part_range(spark, sf_dir)
    backfill(
        lambda a, b: bars.where(F.col("date").between(F.lit(a), F.lit(b))),
        tables.bars, first, last, X.GRID, S.BARS, ["symbol", "time_open"], part="date",
    )
    refresh(spark, tables, first, last, parts_per_job=4)
    return read_table(spark, tables.training, S.TRAINING)


def training_set_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set from bars and targets stored in buckets by symbol, joined where they lie."""
    tables = replace(part_tables(spark), buckets=BUCKETS)
    first, last = X.part_range(spark, sf_dir)
    load_bars(X.bars(spark, sf_dir), tables, first, last)
    tables.write_targets(tables.build_targets(spark, first, last), first, last)
    return tables.build_training(spark, first, last)


def latest_version_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest of several loads of targets, appended to a bucketed table: a wrong one of all, then the right one."""
    found = targets(spark, sf_dir)
    loads = BucketedTable(scratch(spark), S.TARGETS, BUCKETS)
    loads.append(found.withColumn("value", F.lit(0.0).cast("float")))
    loads.append(found)
    newest = R.latest_version(loads.read(spark, version=True), S.TARGET_KEY, [S.VERSION.name])
    return newest.drop(S.VERSION.name)


def new_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars arrive in two loads; each time, the parts they touch are rebuilt."""
    tables = part_tables(spark)
    checkpoint = f"{tables.bars}_progress"
    bars = X.bars(spark, sf_dir)
    length = timedelta(days=X.GRID.part_days)
    first, last = X.part_range(spark, sf_dir)
    middle = first + (last - first) // length // 2 * length
    load_bars(bars, tables, first, middle)
    process_new_bars(spark, tables, checkpoint)
    load_bars(bars, tables, middle + length, last)
    process_new_bars(spark, tables, checkpoint)
    return tables.read_targets(spark)


def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch(spark)
    write_tsv(rows, path)
    return read_tsv(spark, path, rows.schema)


def truncate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the targets table before and after truncation."""
    path = scratch(spark)
    first, last = X.part_range(spark, sf_dir)
    replace_parts(targets(spark, sf_dir), path, first, last, S.TARGETS, S.TARGET_KEY)
    before = read_table(spark, path, S.TARGETS).count()
    truncate(spark, path, S.TARGETS)
    after = read_table(spark, path, S.TARGETS).count()
    schema = T.StructType(
        [T.StructField("moment", T.StringType()), T.StructField("n", T.LongType())]
    )
    return spark.createDataFrame([("before", before), ("after", after)], schema)


def queries() -> dict[str, Query]:
    return {
        "bars_from_trades": bars_from_trades,
        "vwap": vwap,
        "has_full_lookback": has_full_lookback,
        "growth": growth,
        "growth_all": growth_all,
        "dedupe_max": dedupe_max,
        "first_per_bucket": first_per_bucket,
        "targets": targets,
        "targets_of_frames": targets_of_frames,
        "case_grid": case_grid,
        "lookup_any": lookup_any,
        "entry_price": entry_price,
        "case_rows": case_rows,
        "step_change_pct": step_change_pct,
        "step_change_pct_desc": step_change_pct_desc,
        "phase_sums": phase_sums,
        "first_outcome": first_outcome,
        "first_outcome_desc": first_outcome_desc,
        "best_exit": best_exit,
        "liquid_cases": liquid_cases,
        "training_set": training_set,
        "feature_probe": feature_probe,
        "backtest_report": backtest_report,
        "replace_parts": replace_parts_query,
        "latest_version": latest_version,
        "latest_version_in_place": latest_version_in_place,
        "training_set_in_place": training_set_in_place,
        "backfill": backfill_query,
        "new_bars": new_bars,
        "yesterday": yesterday,
        "days_before": days_before,
        "tsv_round_trip": tsv_round_trip,
        "truncate": truncate_query,
    }
