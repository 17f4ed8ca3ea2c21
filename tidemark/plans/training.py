"""The training set, the feature probe and the backtest report."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.prices import avg_price
from tidemark.grid import Grid
from tidemark.operators.cases import (
    FEE,
    NAMES,
    around,
    bars_by_number,
    case_key,
    case_window,
    dense_around,
    entry_column,
    in_phases,
    moments,
    of_parts,
    per_target,
    spread,
    traded,
)
from tidemark.operators.features import (
    MIN_AVG_VOLUME,
    PROFIT_RATIO,
    STOP_RATIO,
    avg_volume_column,
    best_exit_column,
    first_outcome_column,
    last_outcome_of,
    neighbour_column,
    phase_sum_columns,
    step_change_pct,
    step_column,
)

LITERAL_CASES = 1000  # listed pairs that are turned into literal filters


def training_set(
    targets: DataFrame,
    bars: DataFrame,
    grid: Grid,
    first: date | None = None,
    last: date | None = None,
    names: Iterable[str] = NAMES,
    before: int = 239,
    after: int = 60,
    fee: float = FEE,
    stop_ratio: float = STOP_RATIO,
    profit_ratio: float = PROFIT_RATIO,
    min_avg_volume: float = MIN_AVG_VOLUME,
    in_place: bool = False,
) -> DataFrame:
    """Features and outcomes of every named target of parts ``first`` to ``last`` that is liquid.

    Bars and targets are shuffled once, by (symbol, part_name); see ``around``. ``in_place``: both come from tables with
    the same number of buckets by symbol, read by a session of ``joining_in_place``, and nothing is shuffled.
    """
    names = list(names)
    cases = moments(of_parts(targets, names, first, last), names, in_place)
    # The entry bar is read even where the case ends before it.
    rows = around(cases, traded(bars), grid, before, max(after, 1), first, last)
    if after >= 1:
        # The values ride on one row of each case, its entry bar, which every priced case has.
        rows = rows.withColumns({n: in_phases((1,), F.col(n)) for n in names})
        neighbour = neighbour_column(rows, "asc")
    else:
        inside = F.when(F.lead("offset", 1).over(case_window(rows)) <= after, neighbour_column(rows, "asc"))
        neighbour = F.coalesce(inside, F.lit(0.0))
    steps = (
        rows.withColumns({"price_in": entry_column(rows, fee), "neighbour": neighbour})
        .where((F.col("price_in") != 0) & (F.col("offset") <= after))
        .withColumn("step_thousandths", step_column(F.col("neighbour")))
    )
    per_case = (
        steps.groupBy("symbol", "part_name", "target_timestamp")
        .agg(
            *[F.max(n).alias(n) for n in names],
            F.max("price_in").alias(S.ENTRY),
            first_outcome_column(
                "asc", S.AVG, stop_ratio=stop_ratio, profit_ratio=profit_ratio, fee=fee
            ).alias(S.GAIN),
            best_exit_column(fee).alias(S.BEST),
            *phase_sum_columns(),
            avg_volume_column().alias(S.AVG_VOLUME),
        )
        .where(F.col(S.AVG_VOLUME) >= min_avg_volume)
    )
    rows = per_target(per_case, names).withColumnRenamed("symbol", "target_symbol")
    return rows.select(*S.TRAINING.names)


def feature_probe(
    targets: DataFrame,
    bars: DataFrame,
    grid: Grid,
    cases: DataFrame | Iterable[tuple[str, datetime]],
    name: str = "price_increase_1",
    first: date | None = None,
    last: date | None = None,
    before: int = 6,
    after: int = 3,
    stored: bool = True,
) -> DataFrame:
    """The three step sums, against the previous bar, of listed (symbol, time_open) pairs.

    ``cases`` is a frame, or a list of pairs; whether a frame is broadcast is left to its size. Of ``stored`` bars, only the
    parts and symbols that the cases see are read: those of a list of up to ``LITERAL_CASES`` pairs are literals
    that reach the files' statistics and bloom filters, others are looked up in a join. Turn ``stored``
    off where bars are worked out from something else, and looking the cases up first costs more than it spares.
    """
    if not isinstance(cases, DataFrame):
        pairs = list(dict.fromkeys(cases))
        kind = targets.schema["time_open"].dataType.simpleString()
        cases = bars.sparkSession.createDataFrame(pairs, f"symbol string, time_open {kind}")
        if len(pairs) <= LITERAL_CASES:
            stored = False
            symbols = sorted({symbol for symbol, _ in pairs})
            own = {grid.part_of(time) for _, time in pairs}
            seen = own | {part - timedelta(days=grid.part_days) for part in own}
            targets = targets.where(F.col("symbol").isin(symbols) & F.col("part_name").isin(sorted(own)))
            bars = bars.where(F.col("symbol").isin(symbols) & F.col("date").isin(sorted(seen)))
    listed = of_parts(targets, [name], first, last).join(
        cases, ["symbol", "time_open"], "left_semi"
    )
    if stored:
        seen = F.explode(F.array("part_name", F.date_sub("part_name", grid.part_days)))
        keys = listed.select("symbol", seen.alias("date")).distinct()
        bars = bars.join(keys, ["symbol", "date"], "left_semi")
    # lists keep all they are given, so bars are cut down to what the steps need
    bars = bars.select("symbol", "time_open", "date", S.USD, S.COINS)
    rows = dense_around(listed, bars, grid, before, after, first, last)
    steps = step_change_pct(rows, "desc")
    return (
        steps.groupBy(*case_key(steps))
        .agg(*phase_sum_columns())
        .select("target_name", "target_value", "target_timestamp", "symbol", S.RISES, S.FALLS, S.MOVES)
    )


def case_gains(
    targets: DataFrame,
    bars: DataFrame,
    grid: Grid,
    first: date | None = None,
    last: date | None = None,
    after: int = 60,
    fee: float = FEE,
    stop_ratio: float = STOP_RATIO,
    profit_ratio: float = PROFIT_RATIO,
    keep_missing_entry: bool = True,
    in_place: bool = False,
) -> DataFrame:
    """What each target would have gained, walking back from the end of its case.

    Only the bars after the target matter here. The targets of a (symbol, part) are listed in one row, by
    their times, and its bars in another, with an entry for each bar number; both are shuffled once. A time's
    walk reads its bars by their place and is done once for all targets of that time, equal versions of
    which count once; nothing is expanded but the results (``in_place``: both come from bucketed tables, and are not shuffled). Missing bars count as empty bars, which decide
    nothing; a case without any bars gains 0. A missing entry price counts as 0, which every bar exceeds: such a case
    scores as a profit, unless ``keep_missing_entry`` is off and it is left out.
    """
    chosen = of_parts(targets, None, first, last)
    target = F.struct("target_name", F.col("value").alias("target_value"))
    moment = F.struct("time_open", grid.number(F.col("time_open")).alias("target_no"), "targets")
    listed = (
        spread(chosen, in_place)
        .groupBy("symbol", "part_name", "time_open")
        .agg(F.collect_set(target).alias("targets"))
        .groupBy("symbol", "part_name")
        .agg(F.collect_list(moment).alias("moments"))
    )
    prices = bars.withColumn(S.AVG, avg_price())
    held = bars_by_number(prices, grid, 0, [S.LOW, S.AVG, S.HIGH], first, last)

    def entered(m: Column) -> Column:
        place = (m["target_no"] - F.col("first_no")).cast("int")
        price_in = F.coalesce(F.get("bars", place + 1)[S.AVG], F.lit(0.0)) * (1 + fee)
        fields = [m[c].alias(c) for c in ("time_open", "targets")]
        return F.struct(*fields, place.alias("place"), price_in.alias("price_in"))

    def walked(m: Column) -> Column:
        start = m["place"] + 3  # counted from 1, the second bar after the target
        seen = F.greatest(start, F.lit(1))
        near = F.slice("bars", seen, F.greatest(start + (after - 1) - seen, F.lit(0)))
        at_end = F.get("bars", F.when(F.lit(after >= 2), m["place"] + 2))
        gain = last_outcome_of(
            near, m["price_in"], at_end, stop_ratio=stop_ratio, profit_ratio=profit_ratio, fee=fee
        )
        fields = [m[c].alias(c) for c in ("time_open", "targets", "price_in")]
        return F.struct(*fields, gain.alias(S.GAIN))

    gains = (
        listed.join(held.hint("merge"), ["symbol", "part_name"], "left")
        .select("symbol", "part_name", F.explode(F.transform(F.transform("moments", entered), walked)).alias("m"))
        .select(
            "symbol", "part_name", F.col("m.time_open").alias("target_timestamp"), "m.price_in", f"m.{S.GAIN}",
            F.explode("m.targets").alias("target"),
        )
        .select(
            "symbol", "part_name", "target_timestamp", "target.target_name", "target.target_value",
            "price_in", S.GAIN,
        )
    )
    if not keep_missing_entry:
        gains = gains.where(F.col("price_in") != 0)
    return gains


def backtest_report(
    targets: DataFrame, bars: DataFrame, grid: Grid, **settings
) -> DataFrame:
    """Total and mean gain, number of targets and share of wins per target name.

    Gains have three places and are summed as integers, so totals do not depend on row order. Sorted
    by the number in the name; a name without one counts as 0.
    """
    gains = case_gains(targets, bars, grid, **settings)
    thousandths = F.sum(F.rint(F.col(S.GAIN) * 1000).cast("long"))
    rows = F.count(F.lit(1))
    report = gains.groupBy("target_name").agg(
        (thousandths / 1000).alias("ttl_gain_pct"),
        (thousandths / 1000 / rows).alias("avg_gain_pct"),
        rows.alias("ttl_ins"),
        (F.count_if(F.col(S.GAIN) > 0) / rows).alias("win_pct"),
    )
    return report.orderBy(number_in_name(F.col("target_name")), "target_name").select(
        "ttl_gain_pct", "avg_gain_pct", "ttl_ins", "win_pct", "target_name"
    )


def number_in_name(name: Column) -> Column:
    """The third underscore-separated word as a whole number, 0 where it is none."""
    word = F.get(F.split(name, "_"), F.lit(2))
    number = F.when(word.rlike("^[0-9]+$"), word).try_cast("bigint")
    return F.when(number < 2**32, number).otherwise(0)
