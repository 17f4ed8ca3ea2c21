"""Rebuild what newly arrived bars change.

The scheduled run asks for one day by its date. This asks the bar table which parts have new files
instead, so late and repeated days are caught up as well.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas as S
from tidemark.grid import Grid
from tidemark.plans.backfill import Tables, refresh, refresh_changed
from tidemark.schemas import stored


ANY_AGE = "36500d"  # by default, files much older than the newest one are passed over


def joined(parts: Iterable[date], grid: Grid) -> list[tuple[date, date]]:
    """Runs of parts that follow each other."""
    length = timedelta(days=grid.part_days)
    runs: list[tuple[date, date]] = []
    for part in sorted(set(parts)):
        if runs and runs[-1][1] + length == part:
            runs[-1] = (runs[-1][0], part)
        else:
            runs.append((part, part))
    return runs


def affected(parts: list[date], grid: Grid, reach: int = 1) -> list[tuple[date, date]]:
    """Runs of parts that see bars of the given parts: each part itself and the ``reach`` after it."""
    length = timedelta(days=grid.part_days)
    return joined((part + k * length for part in parts for k in range(reach + 1)), grid)


def process_new_bars(spark: SparkSession, tables: Tables, checkpoint: str) -> None:
    """Rebuild targets and training set of every part touched by bar files not yet processed.

    Processes what is there and stops, for any scheduler to call. A batch that fails is repeated as a
    whole; parts are replaced, so repeating is harmless. Where ``tables.digests`` names a folder, only the symbols
    whose bars differ from those last worked on are built again. No file is too old, so the source's list of files it has
    seen grows with the table's files. Files replaced before their turn are skipped:
    their part has newer ones. A part whose last bars were taken away has no new rows to be noticed by
    and needs ``refresh``.
    """

    def rebuild(batch: DataFrame, _batch_id: int) -> None:
        parts = [row["date"] for row in batch.select("date").distinct().collect()]
        if tables.digests is not None:
            for first, last in joined(parts, tables.grid):
                refresh_changed(batch.sparkSession, tables, first, last)
            return
        for first, last in affected(parts, tables.grid, tables.reach):
            refresh(batch.sparkSession, tables, first, last)

    query = (
        spark.readStream.schema(stored(S.BARS))
        .option("ignoreMissingFiles", True)
        .option("maxFileAge", ANY_AGE)
        .parquet(tables.bars)
        .writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
