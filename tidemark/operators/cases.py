"""Cases: the stretch of bars around each target."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.prices import avg_price, phase
from tidemark.grid import Grid
from tidemark.operators.bars import by_part

# The names whose cases are built, and the share of a trade that fees take.
NAMES = ("price_increase_1", "price_increase_2", "price_increase_3", "price_increase_7")
FEE = 0.001
BAR_VALUES = [
    S.OPEN,
    S.HIGH,
    S.LOW,
    S.CLOSE,
    S.USD,
    S.COINS,
    S.TAKER_BUY_COINS,
    S.TAKER_SELL_USD,
    S.TRANSACTIONS,
]


def case_grid(targets: DataFrame, grid: Grid, before: int = 239, after: int = 60) -> DataFrame:
    """One row per target and bar time from ``before`` bars before it to ``after`` bars after it."""
    return (
        targets.withColumnsRenamed({"time_open": "target_timestamp", "value": "target_value"})
        .withColumn("offset", F.explode(F.sequence(F.lit(-before), F.lit(after))))
        .withColumn("timestamp", F.col("target_timestamp") + F.lit(grid.bar) * F.col("offset"))
        .withColumn("interval_id", phase(F.col("offset")))
    )


def entry_price(bars: DataFrame, grid: Grid, fee: float = FEE) -> DataFrame:
    """What a signal at ``target_timestamp`` costs when bought during the following bar."""
    return bars.select(
        "symbol",
        (F.col("time_open") - F.lit(grid.bar)).alias("target_timestamp"),
        (avg_price() * (1 + fee)).alias("price_in"),
    )


def of_parts(
    targets: DataFrame,
    names: Iterable[str] | None = None,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Targets with one of ``names``, of parts ``first`` to ``last``."""
    if names is not None:
        targets = targets.where(F.col("target_name").isin(*names))
    if first is not None:
        targets = targets.where(F.col("part_name") >= F.lit(first))
    if last is not None:
        targets = targets.where(F.col("part_name") <= F.lit(last))
    return targets


def spread(targets: DataFrame, in_place: bool = False) -> DataFrame:
    """Targets dealt by (symbol, part_name); left where they are if bucketed tables have dealt them by symbol."""
    return targets if in_place else targets.repartition("symbol", "part_name")


def moments(targets: DataFrame, names: Iterable[str], in_place: bool = False) -> DataFrame:
    """One row per symbol and time, with a column per name holding the value of that target.

    A case does not depend on which names fired, so it is worked out once for all of them.
    """
    values = [F.max(F.when(F.col("target_name") == n, F.col("value"))).alias(n) for n in names]
    grouped = spread(targets, in_place).groupBy("symbol", "part_name", "time_open")
    return grouped.agg(*values) if values else grouped.agg(F.lit(1)).drop("1")


def per_target(cases: DataFrame, names: Iterable[str]) -> DataFrame:
    """From a row per moment back to a row per target, with ``target_name`` and ``target_value``."""
    pairs = [F.struct(F.lit(n).alias("target_name"), F.col(n).alias("target_value")) for n in names]
    rest = [c for c in cases.columns if c not in names]
    return (
        cases.select(*rest, F.explode(F.array(*pairs)).alias("pair"))
        .select(*rest, "pair.*")
        .where(F.col("target_value").isNotNull())
    )


def around(
    cases: DataFrame,
    bars: DataFrame,
    grid: Grid,
    before: int,
    after: int,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """The bars of each case: one row per case and bar that exists.

    ``cases`` has symbol, part_name, time_open (renamed target_timestamp) and columns to carry along,
    at most one row per bar, name and value, best partitioned by (symbol, part_name). The cases of a
    (symbol, part) are listed in one row, by the stretches of time they touch; every bar of that part
    looks its stretch up and keeps those it belongs to. So bars and cases meet on (symbol, part_name)
    after being shuffled once; the rows they expand into are not shuffled again, and all grouping by
    case happens where they are. (A broadcast of few lists would spare the bars that shuffle, but cost
    the many more expanded rows one, hence the hint.) Only bars of the target's part and the end of
    the one before are seen, so late cases are cut short.
    """
    carried = [c for c in cases.columns if c not in ("symbol", "part_name")]
    stretch = max(1, (before + after) // 4)  # few cases are looked at in vain
    number = F.col("target_no")
    touched = F.sequence(F.floor((number - before) / stretch), F.floor((number + after) / stretch))
    lists = (
        cases.withColumn("target_no", grid.number(F.col("time_open")))
        .withColumn("stretch", F.explode(touched))
        .groupBy("symbol", "part_name", "stretch")
        .agg(F.collect_list(F.struct("target_no", *carried)).alias("cases"))
        .groupBy("symbol", "part_name")
        .agg(F.map_from_entries(F.collect_list(F.struct("stretch", "cases"))).alias("stretches"))
    )
    near = F.try_element_at("stretches", F.floor(F.col("bar_no") / stretch))
    offset = F.col("bar_no") - F.col("case.target_no")
    rows = (
        by_part(bars, grid, max(before, 0), first, last)
        .join(lists.hint("merge"), ["symbol", "part_name"])
        .withColumn("case", F.explode(near))
        .where(offset.between(-before, after))
    )
    kept = [c for c in BAR_VALUES if c in bars.columns]
    return (
        rows.select(
            "symbol",
            "part_name",
            F.col("case.time_open").alias("target_timestamp"),
            *[F.col(f"case.{c}") for c in carried if c != "time_open"],
            F.col("time_open").alias("timestamp"),
            offset.cast("int").alias("offset"),
            *kept,
        )
        .withColumn("interval_id", phase(F.col("offset")))
        .withColumn(S.AVG, avg_price())
    )


def bars_by_number(
    bars: DataFrame,
    grid: Grid,
    back: int,
    values: list[str],
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """One row per (symbol, part_name) with ``first_no`` and ``bars``, which has an entry for each bar number.

    Entry i holds ``values`` of bar ``first_no + i``, and is NULL where that bar is missing, so any bar is read
    by its place. A list never exceeds one part and its lead-in.
    """
    held = F.sort_array(F.collect_list(F.struct("bar_no", *values))).alias("held")
    listed = by_part(bars, grid, back, first, last).groupBy("symbol", "part_name").agg(held)
    entry = T.StructType([bars.schema[c] for c in values])

    def with_gap(bar: Column, place: Column) -> Column:
        following = F.get("held", place + 1)["bar_no"]
        steps = F.coalesce(following - bar["bar_no"], F.lit(1)).cast("int")
        own = F.struct(*[bar[c].alias(c) for c in values])
        missing = F.array_repeat(F.lit(None).cast(entry), steps - 1)
        return F.concat(F.array_repeat(own, F.least(steps, F.lit(1))), missing)

    return listed.select(
        "symbol",
        "part_name",
        F.get("held", F.lit(0))["bar_no"].alias("first_no"),
        F.flatten(F.transform("held", with_gap)).alias("bars"),
    )


def dense_around(
    cases: DataFrame,
    bars: DataFrame,
    grid: Grid,
    before: int,
    after: int,
    first: date | None = None,
    last: date | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Like ``around``, with a row of zeros wherever a bar is missing.

    The cases of a (symbol, part) are listed by their time and meet the bars of it, once; bars are read by
    their place, once for all cases of a time, and the rows they expand into stay where they are.
    """
    kept = [c for c in BAR_VALUES if c in bars.columns]
    lists = bars_by_number(bars, grid, before, kept, first, last)
    listed = cases.withColumnsRenamed({"time_open": "target_timestamp", "value": "target_value"})
    rest = [c for c in listed.columns if c not in ("symbol", "part_name", "target_timestamp")]
    number = grid.number(F.col("target_timestamp")).alias("target_no")
    moment = F.struct("target_timestamp", number, "held")
    moments = (
        spread(listed, in_place)
        .groupBy("symbol", "part_name", "target_timestamp")
        .agg(F.collect_list(F.struct(*rest)).alias("held"))
        .groupBy("symbol", "part_name")
        .agg(F.collect_list(moment).alias("moments"))
    )
    offsets = F.sequence(F.lit(-before), F.lit(after))

    def with_bars(m: Column) -> Column:
        place = (m["target_no"] - F.col("first_no")).cast("int")
        near = F.transform(offsets, lambda o: F.get("bars", place + o))
        return F.struct(m["target_timestamp"].alias("target_timestamp"), m["held"].alias("held"), near.alias("near"))

    zero = {c: F.lit(0).cast(bars.schema[c].dataType) for c in kept}
    rows = (
        moments.join(lists.hint("merge"), ["symbol", "part_name"], "left")
        .select("symbol", "part_name", F.explode(F.transform("moments", with_bars)).alias("m"))
        .select("symbol", "part_name", "m.target_timestamp", "m.held", F.posexplode("m.near").alias("place", "bar"))
        .select(
            "symbol",
            "part_name",
            "target_timestamp",
            (F.col("place") - before).alias("offset"),
            *[F.coalesce(F.col("bar")[c], zero[c]).alias(c) for c in kept],
            F.explode("held").alias("case"),
        )
        .select("*", "case.*")
    )
    timestamp = F.col("target_timestamp") + F.lit(grid.bar) * F.col("offset")
    return rows.withColumns(
        {"timestamp": timestamp, "interval_id": phase(F.col("offset")), S.AVG: avg_price()}
    ).select(*listed.columns, "offset", "timestamp", "interval_id", *kept, S.AVG)


def traded(bars: DataFrame) -> DataFrame:
    """Bars with a volume."""
    return bars.where((F.col(S.USD) != 0) & (F.col(S.COINS) != 0))


def case_key(df: DataFrame) -> list[str]:
    """The columns that tell one case from another, first the one that tells the most.

    Sorts compare rows by their first column alone where they can.
    """
    names = ["target_timestamp", "symbol", "part_name", "target_name", "target_value"]
    return [c for c in names if c in df.columns]


def case_window(rows: DataFrame) -> WindowSpec:
    """The rows of a case in time order."""
    return Window.partitionBy(*case_key(rows)).orderBy("offset")


def entry_column(rows: DataFrame, fee: float = FEE) -> Column:
    """What a case costs at its entry bar, on each of its rows; 0 without one.

    The entry bar is one of the case's own rows, so no second join with the bars is needed.
    """
    whole = case_window(rows).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at_entry = F.max(in_phases((1,), F.col(S.AVG))).over(whole)
    return F.coalesce(at_entry, F.lit(0.0)) * (1 + fee)


def with_entry(rows: DataFrame, fee: float = FEE) -> DataFrame:
    """Add ``price_in``, what the case costs."""
    return rows.withColumn("price_in", entry_column(rows, fee))


def case_rows(
    targets: DataFrame,
    bars: DataFrame,
    grid: Grid,
    names: Iterable[str] | None = NAMES,
    first: date | None = None,
    last: date | None = None,
    before: int = 239,
    after: int = 60,
    fee: float = FEE,
    in_place: bool = False,
) -> DataFrame:
    """The traded bars around each named target, with the phase of each row and the entry price.

    Cases without an entry price are left out; versions of a target that are equal count once. ``in_place``: targets
    and bars come from bucketed tables, and are not shuffled.
    """
    chosen = of_parts(targets, names, first, last).withColumnRenamed("value", "target_value")
    different = spread(chosen, in_place).dropDuplicates()
    # the entry bar is read even where the case ends before it
    rows = around(different, traded(bars), grid, before, max(after, 1), first, last)
    return with_entry(rows, fee).where((F.col("price_in") != 0) & (F.col("offset") <= after))


def in_phases(phases: tuple[int, ...], value: Column) -> Column:
    """A value on rows of the given phases, NULL elsewhere, for use inside aggregates."""
    return F.when(F.col("interval_id").isin(*phases), value)
