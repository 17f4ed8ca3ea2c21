"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Each query runs ``$BENCH_RUNS`` times after one
warm-up run; its median is reported, and their sum is the metric.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import fixture as X  # noqa: E402
from checks import queries as Q  # noqa: E402
from tidemark import Grid  # noqa: E402
from tidemark.operators.bars import bars_from_trades  # noqa: E402
from tidemark.operators.targets import growth, targets  # noqa: E402
from tidemark.plans.training import backtest_report  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def targets_per_horizon(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The targets of one horizon each, for comparison with the single pass."""
    bars = X.bars(spark, sf_dir)
    return [
        targets(bars, X.GRID, horizons=[k], lookback=X.LOOKBACK, bucket=X.BUCKET)
        for k in X.HORIZONS
    ]


HEADLINES = {
    "bars_from_trades": Q.bars_from_trades,
    "growth_all": Q.growth_all,
    "targets": Q.targets,
    "targets_of_frames": Q.targets_of_frames,
    "case_rows": Q.case_rows,
    "lookup_any": Q.lookup_any,
    "first_outcome": Q.first_outcome,
    "training_set": Q.training_set,
    "feature_probe": Q.feature_probe,
    "backtest_report": Q.backtest_report,
    "latest_version": Q.latest_version,
    "backfill": Q.backfill_query,
}

def minutes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Minute bars of 20 symbols and 4 days, with lines dealt over the minutes as trades, and their targets; stored."""
    if not _minutes:
        lines, grid = X.table(spark, sf_dir, "lineitem"), Grid()
        deal = F.xxhash64("l_orderkey", "l_linenumber", "l_partkey")
        minute = F.pmod(deal, F.lit(4 * grid.bars_per_part))
        price = (F.lit(100) + F.pmod(deal, F.lit(503)) / 100).cast("decimal(9,2)")
        coins = F.col("l_quantity").cast("bigint")
        bars = bars_from_trades(
            lines, grid, symbol=F.col("l_suppkey") % 20, price=price.cast("double"), coins=coins, usd=price * coins,
            ts=F.lit("2023-02-01").cast("timestamp_ntz") + F.lit(grid.bar) * minute,
            taker_buys=F.col("l_returnflag") == "N", order=[deal],
        )
        folder = f"{spark.conf.get('spark.checkpoint.dir')}/minutes"
        bars.write.parquet(f"{folder}/bars")
        bars = spark.read.parquet(f"{folder}/bars")
        targets(bars, grid, bucket=1).write.parquet(f"{folder}/targets")
        _minutes.extend([bars, spark.read.parquet(f"{folder}/targets")])
    return tuple(_minutes)


_minutes: list[DataFrame] = []


def report_of_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars, found = minutes(spark, sf_dir)
    return backtest_report(found, bars, Grid())


def growth_of_minutes(spark: SparkSession, sf_dir: str, frame: tuple[int, int] = (1, 1)) -> DataFrame:
    return growth(minutes(spark, sf_dir)[0], Grid(), *frame)


#: Timed for comparison and left out of the metric: other ways to the same results, and minute bars.
COMPARED = {
    "targets_per_horizon": targets_per_horizon,
    "report_of_minutes": report_of_minutes,
    "growth_of_minutes_1_1": growth_of_minutes,
    "growth_of_minutes_1_300": lambda spark, sf_dir: growth_of_minutes(spark, sf_dir, (1, 300)),
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, query) -> float:
    start = time.perf_counter()
    built = query(spark, SF_DIR)
    for df in built if isinstance(built, list) else [built]:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(spark: SparkSession, queries: dict) -> dict[str, float]:
    """Median seconds of each query, after one run to warm up."""
    seconds = {}
    for name, query in queries.items():
        run(spark, query)
        seconds[name] = round(statistics.median(run(spark, query) for _ in range(RUNS)), 3)
    return seconds


def main() -> None:
    spark = session()
    seconds, compared = timed(spark, HEADLINES), timed(spark, COMPARED)
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").agg(F.count("*")).first()[0]
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "compared": compared,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "lineitem_rows": lines,
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
