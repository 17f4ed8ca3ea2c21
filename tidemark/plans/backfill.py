"""Rebuilding ranges of parts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.grid import Grid
from tidemark.operators.targets import targets
from tidemark.plans.training import training_set
from tidemark.sources.buckets import BucketedTable, joining_in_place
from tidemark.sources.tables import RunLog, parts_state, read_table, replace_parts

Builder = Callable[[date, date], DataFrame]
State = Callable[[date, date], str]


def spans(
    first: date, last: date, grid: Grid, parts_per_job: int | None
) -> Iterator[tuple[date, date]]:
    """Cut a range of parts into runs of ``parts_per_job``; one run if None."""
    length = timedelta(days=grid.part_days)
    run = (last - first) // length if parts_per_job is None else parts_per_job - 1
    while first <= last:
        end = min(first + run * length, last)
        yield first, end
        first = end + length


def backfill(
    build: Builder,
    path: str,
    first: date,
    last: date,
    grid: Grid,
    schema,
    key: list[str],
    part: str = "part_name",
    parts_per_job: int | None = None,
    log: RunLog | None = None,
    inputs: State | None = None,
    buckets: int | None = None,
) -> list[tuple[date, date]]:
    """Build parts ``first`` to ``last`` and replace them in the table at ``path``; the runs that were built.

    All parts of a run are one Spark job over one scan. ``parts_per_job`` bounds how much a failed
    run has to repeat. With a ``log``, a run is passed over that was finished before, if neither its input
    (``inputs`` tells the state of what parts of it are built from) nor what it wrote has changed since.
    With ``buckets``, the table is bucketed by symbol.
    """
    done = []
    for start, end in spans(first, last, grid, parts_per_job):
        name = f"{path.rstrip('/').rsplit('/', 1)[-1]}-{start}-{end}"
        spark, before = None, inputs(start, end) if log and inputs else ""
        if log and inputs:
            spark = log.spark
            held = f"{before} {parts_state(spark, path, start, end, part)}"
            if log.read(name) == held:
                continue
        write_parts(build(start, end), path, start, end, schema, key, part, buckets)
        if spark:
            log.write(name, f"{before} {parts_state(spark, path, start, end, part)}")
        done.append((start, end))
    return done


def write_parts(
    df: DataFrame, path: str, first: date, last: date, schema, key: list[str], part: str, buckets: int | None
) -> None:
    """Replace parts of a table, bucketed by symbol or not."""
    if buckets:
        BucketedTable(path, schema, buckets, part).replace(df, first, last)
    else:
        replace_parts(df, path, first, last, schema, key, part)


@dataclass(frozen=True)
class Tables:
    """Where the three tables lie, and the settings they are built with."""

    bars: str
    targets: str
    training: str
    grid: Grid = Grid()
    target_settings: tuple[tuple[str, Any], ...] = ()
    training_settings: tuple[tuple[str, Any], ...] = ()
    digests: str | None = None  # where the bars that were worked on are remembered, by symbol and part
    buckets: int | None = None  # of bars and targets, by symbol; the training set is then built without a shuffle

    @property
    def reach(self) -> int:
        """How many parts later a bar still matters: more where buckets of targets straddle parts."""
        return 2 if self.grid.bars_per_part % dict(self.target_settings).get("bucket", 10) else 1

    def read_bars(self, spark: SparkSession) -> DataFrame:
        if self.buckets:
            return BucketedTable(self.bars, S.BARS, self.buckets, "date").read(spark)
        return read_table(spark, self.bars, S.BARS)

    def read_targets(self, spark: SparkSession) -> DataFrame:
        if self.buckets:
            return BucketedTable(self.targets, S.TARGETS, self.buckets).read(spark)
        return read_table(spark, self.targets, S.TARGETS)

    def write_targets(self, df: DataFrame, first: date, last: date) -> None:
        write_parts(df, self.targets, first, last, S.TARGETS, S.TARGET_KEY, "part_name", self.buckets)

    def build_targets(self, spark: SparkSession, first: date, last: date) -> DataFrame:
        return targets(
            self.read_bars(spark), self.grid, first, last, **dict(self.target_settings)
        )

    def build_training(self, spark: SparkSession, first: date, last: date) -> DataFrame:
        spark = joining_in_place(spark) if self.buckets else spark
        return training_set(
            self.read_targets(spark),
            self.read_bars(spark),
            self.grid,
            first,
            last,
            in_place=bool(self.buckets),
            **dict(self.training_settings),
        )


def refresh(
    spark: SparkSession,
    tables: Tables,
    first: date,
    last: date,
    parts_per_job: int | None = None,
    log: str | None = None,
) -> list[tuple[date, date]]:
    """Rebuild targets, then the training set, of parts whose bars are in place; the runs that were built.

    With a folder for a ``log``, a refresh that was stopped half-way repeats only the runs that were not
    finished, and those whose bars or targets have changed since.
    """
    grid = tables.grid
    noted = RunLog(spark, log) if log else None
    length = timedelta(days=grid.part_days)

    def bars(a: date, b: date, parts: int) -> str:
        return parts_state(spark, tables.bars, a - parts * length, b, "date")

    def bars_and_targets(a: date, b: date) -> str:
        return f"{bars(a, b, 1)} {parts_state(spark, tables.targets, a, b)} {tables.training_settings}"

    return backfill(
        lambda a, b: tables.build_targets(spark, a, b),
        tables.targets, first, last, grid, S.TARGETS, S.TARGET_KEY, parts_per_job=parts_per_job,
        log=noted, inputs=lambda a, b: f"{bars(a, b, tables.reach)} {tables.target_settings}",
        buckets=tables.buckets,
    ) + backfill(
        lambda a, b: tables.build_training(spark, a, b),
        tables.training, first, last, grid, S.TRAINING, S.TRAINING_KEY, parts_per_job=parts_per_job,
        log=noted, inputs=bars_and_targets,
    )


def digests(bars: DataFrame, first: date, last: date) -> DataFrame:
    """symbol, date and a digest of the bars of each symbol in parts ``first`` to ``last``, in any order of rows."""
    row = F.xxhash64(*S.BARS.names).cast("decimal(38,0)")
    held = bars.where(F.col("date").between(F.lit(first), F.lit(last)))
    return held.groupBy("symbol", "date").agg(F.concat_ws(":", F.sum(row), F.count(F.lit(1))).alias("digest"))


def refresh_changed(spark: SparkSession, tables: Tables, first: date, last: date) -> DataFrame:
    """Rebuild what changed bars of parts ``first`` to ``last`` touch; the (symbol, date) that had changed.

    Bars are compared with ``tables.digests``, by symbol and part. A changed one, also one that has
    vanished, touches its symbol in its part and in the next (with buckets that straddle parts, the next two). Only those
    are worked out again; the other rows of the part are written as they stand. A part without digests counts as
    changed whole. Digests are replaced last, so a run that fails is repeated.
    """
    if tables.digests is None:
        raise ValueError("tables.digests names no folder")
    grid, length = tables.grid, timedelta(days=tables.grid.part_days)
    now = digests(tables.read_bars(spark), first, last)
    files = spark._jvm.org.apache.hadoop.fs.Path(tables.digests)
    if files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files):
        was = read_table(spark, tables.digests, S.DIGESTS)
    else:
        was = spark.createDataFrame([], S.DIGESTS)
    was = was.where(F.col("date").between(F.lit(first), F.lit(last))).withColumnRenamed("digest", "was")
    changed = now.join(was, ["symbol", "date"], "full").where(~F.col("digest").eqNullSafe(F.col("was")))
    folder = f"{tables.digests.rstrip('/')}_changed"
    changed.select("symbol", "date").write.mode("overwrite").parquet(folder)  # read twice, and written only once
    changed = spark.read.schema("symbol string, date date").parquet(folder)
    end = last + tables.reach * length
    seen = F.explode(F.array(*[F.date_add("date", k * grid.part_days) for k in range(tables.reach + 1)]))
    opened = changed.select("symbol", seen.alias("part_name")).distinct()
    own = changed.select("symbol").distinct()
    bars = tables.read_bars(spark).join(own, "symbol", "left_semi")
    if not changed.isEmpty():
        key = ["symbol", "part_name"]
        found = targets(bars, grid, first, end, **dict(tables.target_settings)).join(opened, key, "left_semi")
        kept = _stored_or_none(spark, tables.targets, S.TARGETS)
        tables.write_targets(_with_kept(found, kept, opened, key), first, end)
        built = training_set(
            tables.read_targets(spark).join(opened, key, "left_semi"), bars, grid, first, end,
            **dict(tables.training_settings),
        )
        kept = _stored_or_none(spark, tables.training, S.TRAINING)
        opened = opened.withColumnRenamed("symbol", "target_symbol")
        rows = _with_kept(built, kept, opened, ["target_symbol", "part_name"])
        replace_parts(rows, tables.training, first, end, S.TRAINING, S.TRAINING_KEY)
    replace_parts(now, tables.digests, first, last, S.DIGESTS, ["symbol"], part="date")
    return changed


def _stored_or_none(spark: SparkSession, path: str, schema) -> DataFrame | None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)
    return read_table(spark, path, schema) if exists else None


def _with_kept(built: DataFrame, kept: DataFrame | None, opened: DataFrame, key: list[str]) -> DataFrame:
    """The rows built anew, and those of the table that nothing has touched."""
    return built if kept is None else built.unionByName(kept.join(opened, key, "left_anti"))


def load_bars(bars: DataFrame, tables: Tables, first: date, last: date) -> None:
    """Replace parts of the bar table."""
    write_parts(bars, tables.bars, first, last, S.BARS, ["symbol", "time_open"], "date", tables.buckets)


def daily(spark: SparkSession, bars: DataFrame, tables: Tables, as_of: date) -> None:
    """The daily run: the bars of the part before ``as_of``, then its targets and training set."""
    day = as_of - timedelta(days=tables.grid.part_days)
    load_bars(bars, tables, day, day)
    refresh(spark, tables, day, day)
