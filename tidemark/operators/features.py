"""Features and outcomes of a case.

Each operator comes twice: as aggregate expressions over case rows (``*_columns``), which reports
combine in a single aggregation, and as an operator that returns one row per case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.numbers import exact_sum, half_even
from tidemark.operators.cases import FEE, case_key, case_window, in_phases

LEAD_UP = (0, -1)
AFTERMATH = (2,)

# Where a position is closed, what that counts, and the least volume of a case.
STOP_RATIO = 0.5
STOP_VALUE = -50.0
PROFIT_RATIO = 1.001 + 1 / 100
PROFIT_VALUE = 1.0
MIN_AVG_VOLUME = 50000


def neighbour_column(rows: DataFrame, order: str = "asc") -> Column:
    """Average price of the row's neighbour in its case: the later one for ``asc``, else the earlier."""
    return {"asc": F.lead, "desc": F.lag}[order](S.AVG, 1).over(case_window(rows))


def step_column(neighbour: Column) -> Column:
    """Percent change against a neighbouring price, in thousandths rounded down; 0 next to none."""
    change = F.when(neighbour != 0, F.col(S.AVG) * 100 / neighbour - 100).otherwise(F.lit(0.0))
    return F.floor(change * 1000)


def step_change_pct(rows: DataFrame, order: str = "asc") -> DataFrame:
    """Add the percent change of each row's average price against its neighbour in the case.

    Rounded down to three places; 0 at the end of the case and next to a price of 0.
    ``step_thousandths`` holds the same value as an integer, so that sums of it are exact.
    """
    return (
        rows.withColumn("neighbour", neighbour_column(rows, order))
        .withColumn("step_thousandths", step_column(F.col("neighbour")))
        .withColumn(S.STEP, F.col("step_thousandths") / 1000)
        .drop("neighbour")
    )


def phase_sum_columns() -> list[Column]:
    """Sums of rises, falls and all steps up to the target, rounded half to even to two places."""
    step = F.col("step_thousandths")
    parts = {S.RISES: F.when(step > 0, step), S.FALLS: F.when(step < 0, step), S.MOVES: step}
    return [
        (
            half_even(F.coalesce(F.sum(in_phases(LEAD_UP, part)), F.lit(0)) / 10.0, 0) / 100
        ).alias(name)
        for name, part in parts.items()
    ]


def phase_sums(steps: DataFrame) -> DataFrame:
    """The three step sums of each case."""
    return steps.groupBy(*case_key(steps)).agg(*phase_sum_columns())


def first_outcome_column(
    order: str = "asc",
    exit_price: str = S.AVG,
    stop_ratio: float = STOP_RATIO,
    stop_value: float = STOP_VALUE,
    profit_ratio: float = PROFIT_RATIO,
    profit_value: float = PROFIT_VALUE,
    fee: float = FEE,
    last_offset: int | None = None,
) -> Column:
    """What a position entered at ``price_in`` ends with, walking the aftermath in ``order``.

    The first bar that falls to the stop or rises to the profit decides. If none does, the position is
    closed at ``exit_price`` of the walk's last bar, unless that bar is empty. The last bar is the last
    row there is, or, for walks over whole grids whose missing bars have no row, the one at
    ``last_offset``. Written with ``min_by``/``max_by`` on the row's offset, so it aggregates partially
    and needs no sorted lists.
    """
    take_first, take_last = {"asc": (F.min_by, F.max_by), "desc": (F.max_by, F.min_by)}[order]
    low, avg, high, entry = F.col(S.LOW), F.col(S.AVG), F.col(S.HIGH), F.col("price_in")
    empty = (low == 0) | (avg == 0)
    event = (
        F.when(empty, F.lit(None))
        .when(low <= entry * stop_ratio, F.lit(stop_value))
        .when((high + avg) / 2 >= entry * profit_ratio, F.lit(profit_value))
    )
    place = in_phases(AFTERMATH, F.col("offset"))
    first_event = take_first(event, F.when(event.isNotNull(), place))
    if last_offset is None:
        closing_price = F.when(~take_last(empty, place), take_last(F.col(exit_price), place))
    else:
        at_end = (F.col("offset") == last_offset) & ~empty
        closing_price = F.max(F.when(at_end, F.col(exit_price)))
    closing = F.try_divide(closing_price * (1 - fee) * 100, F.max("price_in")) - 100
    return half_even(F.coalesce(first_event, closing, F.lit(0.0)), 3)


def last_outcome_of(
    bars: Column,
    entry: Column,
    at_end: Column,
    exit_price: str = S.LOW,
    stop_ratio: float = STOP_RATIO,
    stop_value: float = STOP_VALUE,
    profit_ratio: float = PROFIT_RATIO,
    profit_value: float = PROFIT_VALUE,
    fee: float = FEE,
) -> Column:
    """As ``first_outcome_column`` with order ``desc``, of a list of the aftermath's bars in time order.

    Each bar has its low, average and high price; missing bars are NULL. ``at_end`` is the bar at which the
    walk ends, with the exit price. The list is folded from its front, where later bars overrule earlier ones.
    """

    def full(bar: Column) -> Column:
        return (bar[S.LOW] != 0) & (bar[S.AVG] != 0)

    def event(decided: Column, bar: Column) -> Column:
        stopped = full(bar) & (bar[S.LOW] <= entry * stop_ratio)
        won = full(bar) & ((bar[S.HIGH] + bar[S.AVG]) / 2 >= entry * profit_ratio)
        return F.when(stopped, F.lit(stop_value)).when(won, F.lit(profit_value)).otherwise(decided)

    events = F.aggregate(bars, F.lit(None).cast("double"), event)
    price = F.when(full(at_end), at_end[exit_price])
    closing = F.try_divide(price * (1 - fee) * 100, entry) - 100
    return half_even(F.coalesce(events, closing, F.lit(0.0)), 3)


def first_outcome(rows: DataFrame, **settings) -> DataFrame:
    """The outcome of each case."""
    return rows.groupBy(*case_key(rows)).agg(first_outcome_column(**settings).alias(S.GAIN))


def best_exit_column(fee: float = FEE) -> Column:
    """The best gain the aftermath offered, in whole percent rounded down; 0 without an aftermath."""
    gain = F.try_divide(F.col(S.AVG) * (1 - fee) * 100, F.col("price_in")) - 100
    return F.coalesce(F.floor(F.max(in_phases(AFTERMATH, gain))).cast("double"), F.lit(0.0))


def best_exit(rows: DataFrame, fee: float = FEE) -> DataFrame:
    """The best exit of each case."""
    return rows.groupBy(*case_key(rows)).agg(best_exit_column(fee).alias(S.BEST))


def avg_volume_column() -> Column:
    """Mean volume in usd per bar up to the target, rounded down."""
    usd = exact_sum(in_phases(LEAD_UP, F.col(S.USD)))
    bars = F.count(in_phases(LEAD_UP, F.lit(1)))
    return F.floor(F.try_divide(usd, bars)).cast("double")


def liquid_cases(rows: DataFrame, min_avg_volume: float = MIN_AVG_VOLUME) -> DataFrame:
    """Cases that traded at least ``min_avg_volume`` usd per bar up to the target."""
    return (
        rows.groupBy(*case_key(rows))
        .agg(avg_volume_column().alias(S.AVG_VOLUME))
        .where(F.col(S.AVG_VOLUME) >= min_avg_volume)
    )
