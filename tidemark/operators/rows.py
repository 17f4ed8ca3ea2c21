"""Operators on keyed rows that know nothing of prices."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.grid import Grid


def dedupe_max(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per key, with the greatest value."""
    return df.groupBy(*keys).agg(F.max(value).alias(value))


def first_per_bucket(
    df: DataFrame, grid: Grid, keys: list[str], time_column: str, bucket: int = 10
) -> DataFrame:
    """The earliest row per key and stretch of ``bucket`` bars; of rows with equal times, one.

    A plain aggregate: each task keeps one row per group before the shuffle, whatever the group's
    size. With one more column it aggregates by hash.
    """
    rest = [c for c in df.columns if c not in keys and c != time_column]
    stretch = F.floor(grid.number(F.col(time_column)) / bucket)
    grouped = df.groupBy(*keys, stretch.alias("bucket"))
    if len(rest) == 1:
        value = F.min_by(rest[0], time_column).alias(rest[0])
        earliest = grouped.agg(F.min(time_column).alias(time_column), value)
    else:
        earliest = grouped.agg(F.min(F.struct(time_column, *rest)).alias("row"))
        earliest = earliest.select(*keys, "row.*")
    return earliest.select(*df.columns)


def lookup_any(
    left: DataFrame, right: DataFrame, keys: list[str], defaults: dict[str, Any]
) -> DataFrame:
    """Left join with at most one match per left row; where there is none, the defaults.

    ``defaults`` names the columns taken from the right side. Of several matches the greatest row is
    taken, so reruns agree. The join compares a hash besides the keys: it gives the unique rows a
    shuffle of their own, without which adaptive execution could not split a hot key of the left side.
    """
    columns = list(defaults)
    unique = right.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("match"))
    found = left.withColumn("key_hash", F.xxhash64(*keys)).join(
        unique.withColumn("key_hash", F.xxhash64(*keys)), [*keys, "key_hash"], "left"
    )
    filled = {c: F.coalesce(F.col(f"match.{c}"), F.lit(d)) for c, d in defaults.items()}
    return found.withColumns(filled).drop("match", "key_hash")


def latest_version(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The newest row per key; ``version`` columns are compared in order.

    The other columns may be of any type. Of rows equal in key and version, any one is taken.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("row")
    return df.groupBy(*keys).agg(newest).select(*keys, "row.*").select(*df.columns)


def days_before(df: DataFrame, column: str, as_of: date, days: int = 1) -> DataFrame:
    """Rows of the ``days`` days before ``as_of``, by a date or timestamp column.

    The bounds are literals of the column's own type, so they prune partitions and row groups.
    """
    start, end = as_of - timedelta(days=days), as_of
    return df.where((F.col(column) >= _bound(df, column, start)) & (F.col(column) < _bound(df, column, end)))


def yesterday(df: DataFrame, column: str, as_of: date) -> DataFrame:
    """Rows of the day before ``as_of``."""
    return days_before(df, column, as_of)


def _bound(df: DataFrame, column: str, day: date) -> Column:
    return F.lit(datetime.combine(day, time(0)).isoformat(" ")).cast(df.schema[column].dataType)
