"""Finding the bars that follow a rise: growth over horizons, thinned to one signal per stretch."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.numbers import divide, floor_thousandths, running_sum, sum_between
from tidemark.grid import Grid
from tidemark.operators.bars import by_part, full_lookback, part_window
from tidemark.operators.rows import dedupe_max, first_per_bucket

HORIZONS = range(1, 21)
NAME = "price_increase_{}"
VOLUMES = (S.USD, S.COINS)


Horizon = int | tuple[int, int]


def frame_of(horizon: Horizon) -> tuple[str, tuple[int, int]]:
    """The name of a horizon's targets, and the rows back it compares with."""
    if isinstance(horizon, int):
        return NAME.format(horizon), (horizon, horizon)
    start, end = horizon
    return (NAME.format(start) if start == end else f"{NAME.format(start)}_to_{end}"), (start, end)


def _with_frame_prices(rows: DataFrame, frames: dict[str, tuple[int, int]]) -> DataFrame:
    """A part's own bars with the average price of each frame of several rows, from differences of running sums.

    Totals are columns of their own, so that each is worked out once.
    """
    wide = {name: frame for name, frame in frames.items() if frame[0] < frame[1]}
    own = F.col("date") == F.col("part_name")
    if not wide:
        return rows.where(own)
    rows = rows.withColumns({f"{c}_sums": running_sum(F.col(c), part_window()) for c in VOLUMES})
    ends = {k for start, end in wide.values() for k in (start, end + 1)}
    rows = rows.withColumns(
        {f"{c}_{k}": F.lag(f"{c}_sums", k).over(part_window()) for c in VOLUMES for k in sorted(ends)}
    )
    totals = {
        f"{name}_{c}": sum_between(F.col(f"{c}_{end + 1}"), F.col(f"{c}_{start}"))
        for name, (start, end) in wide.items()
        for c in VOLUMES
    }
    rows = rows.where(own).withColumns(totals)
    return rows.withColumns({n: divide(*(F.col(f"{n}_{c}") for c in VOLUMES)) for n in wide})


def _with_earlier(
    bars: DataFrame,
    grid: Grid,
    frames: dict[str, tuple[int, int]],
    lookback: int,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Add each bar's price and one earlier price per frame, all under one window and one sort.

    A frame's sums are differences of running sums, whatever its width.
    """
    for start, end in frames.values():
        if not 0 <= start <= end <= lookback:
            raise ValueError(f"rows {end}..{start} back must lie within the lookback of {lookback}")
    rows = by_part(bars, grid, lookback, first, last)
    rows = rows.withColumn("price", divide(F.col(S.USD), F.col(S.COINS)))
    single = {n: F.lag("price", start).over(part_window()) for n, (start, end) in frames.items() if start == end}
    flag = {"is_full_lookback": full_lookback(lookback)}
    return _with_frame_prices(rows.withColumns(single | flag), frames)


def _growth(earlier: str) -> Column:
    ratio = divide(F.col("price"), F.col(earlier))
    return F.when(F.col("is_full_lookback"), floor_thousandths(ratio))


def growth(
    bars: DataFrame, grid: Grid, start: int, end: int, lookback: int = 300
) -> DataFrame:
    """Add each bar's average price relative to that of rows ``end`` to ``start`` before it.

    Rounded down to three places. NULL without a full lookback or where the ratio is not finite.
    """
    rows = _with_earlier(bars, grid, {"earlier": (start, end)}, lookback)
    return rows.select(*bars.columns, _growth("earlier").alias("growth"))


def growth_all(
    bars: DataFrame,
    grid: Grid,
    horizons: Iterable[Horizon] = HORIZONS,
    lookback: int = 300,
    first: date | None = None,
    last: date | None = None,
    at_least: float | None = None,
) -> DataFrame:
    """Growth for every horizon, one row per bar and horizon, in one pass over the bars.

    A horizon is a number of bars back, or the first and the last bar back of a frame whose average price
    is compared.

    With ``at_least``, only rows that reach it. Most bars reach it at no horizon and are dropped by
    one comparison with their lowest earlier price, before anything is divided or multiplied out. The
    rows stay partitioned by (symbol, part_name), which an unpivot would forget.
    """
    frames = dict(map(frame_of, horizons))
    wide = _with_earlier(bars, grid, frames, lookback, first, last)
    if at_least is not None:
        lowest = F.array_min(F.array(*frames))
        # Rounding down never raises a ratio; the thousandth of slack covers float noise.
        wide = wide.where(
            F.col("is_full_lookback") & (F.col("price") >= lowest * (at_least - 0.001))
        )
    pairs = [F.struct(F.lit(c).alias("target_name"), F.col(c).alias("earlier")) for c in frames]
    long = wide.withColumn("pair", F.explode(F.array(*pairs))).select(
        "*", "pair.target_name", "pair.earlier"
    )
    growths = long.select(
        "symbol", "part_name", "time_open", "target_name", _growth("earlier").alias("value")
    )
    return growths if at_least is None else growths.where(F.col("value") >= at_least)


def targets(
    bars: DataFrame,
    grid: Grid,
    first: date | None = None,
    last: date | None = None,
    horizons: Iterable[Horizon] = HORIZONS,
    min_growth: float = 1.01,
    lookback: int = 300,
    bucket: int = 10,
) -> DataFrame:
    """Bars of parts ``first`` to ``last`` that grew by ``min_growth``, one per symbol, name and bucket.

    The threshold is applied to the double; the value is narrowed to a float afterwards. Where buckets
    divide a part, as ten minutes do a day, both aggregations stay inside the (symbol, part)
    partitions of the growth window, and there is one shuffle in all. A bucket that straddles parts keeps its
    earliest bar of either: when parts are rebuilt alone, the part before the first is looked at again for that
    bucket's bars, and so hands it on.
    """
    if bucket > grid.bars_per_part:
        raise ValueError(f"a bucket of {bucket} bars spans more than two parts of {grid.bars_per_part}")
    straddling = grid.bars_per_part % bucket != 0
    start = first - timedelta(days=grid.part_days) if straddling and first is not None else first
    hits = growth_all(bars, grid, horizons, lookback, start, last, at_least=min_growth)
    if start != first:
        opened = grid.first_bar(first) // bucket
        shared = F.floor(grid.number(F.col("time_open")) / bucket) == opened
        hits = hits.where((F.col("part_name") >= F.lit(first)) | shared)
    unique = dedupe_max(hits, ["symbol", "part_name", "target_name", "time_open"], "value")
    keys = ["symbol", "target_name"] if straddling else ["symbol", "part_name", "target_name"]
    thinned = first_per_bucket(unique, grid, keys, "time_open", bucket)
    if start != first:
        thinned = thinned.where(F.col("part_name") >= F.lit(first))
    return thinned.withColumn("value", F.col("value").cast("float")).select(*S.TARGETS.names)
