import pytest
from pyspark.sql import functions as F

from checks import fixture as X
from checks import queries as Q
from tidemark import schemas as S
from tidemark.functions.numbers import divide, floor_thousandths, half_even
from tidemark.operators import features as E


def steps(make_case, prices, order):
    rows = make_case([(i, p, p, p) for i, p in enumerate(prices)])
    return [r[S.STEP] for r in E.step_change_pct(rows, order).orderBy("offset").collect()]


def test_step_change(make_case):
    assert steps(make_case, [100, 102, 101], "asc") == [-1.961, 0.990, 0.0]
    assert steps(make_case, [100, 102, 101], "desc") == [0.0, 2.0, -0.981]


def test_step_change_next_to_a_missing_bar(make_case):
    assert steps(make_case, [100, 0], "desc") == [0.0, -100.0]
    assert steps(make_case, [0, 100], "desc") == [0.0, 0.0]


def sums(make_case, thousandths):
    rows = make_case([(-i, 1, 1, 1) for i in range(len(thousandths))])
    values = F.element_at(F.array(*[F.lit(t) for t in thousandths]), 1 - F.col("offset"))
    stepped = rows.withColumn("step_thousandths", values.cast("bigint"))
    return tuple(E.phase_sums(stepped).first()[c] for c in (S.RISES, S.FALLS, S.MOVES))


def test_phase_sums_round_half_to_even(make_case):
    assert sums(make_case, [100, 25]) == (0.12, 0.0, 0.12)
    assert sums(make_case, [100, 35]) == (0.14, 0.0, 0.14)
    assert sums(make_case, [100, -25]) == (0.1, -0.02, 0.08)


def test_phase_sums_ignore_later_phases(make_case):
    rows = make_case([(0, 1, 1, 1), (1, 1, 1, 1), (2, 1, 1, 1)])
    stepped = rows.withColumn("step_thousandths", F.lit(1000).cast("bigint"))
    assert E.phase_sums(stepped).first()[S.MOVES] == 1.0


def outcome(make_case, rows, entry=100.0, **settings):
    return E.first_outcome(make_case(rows, entry), **settings).first()[S.GAIN]


def test_first_outcome(make_case):
    assert outcome(make_case, [(2, 0, 60, 80), (3, 40, 60, 80)]) == -50.0
    assert outcome(make_case, [(2, 99, 101, 102)]) == 1.0
    assert outcome(make_case, [(2, 99, 100, 101)]) == -0.1
    assert outcome(make_case, [(2, 99, 100, 101)], exit_price=S.LOW) == -1.099
    assert outcome(make_case, [(0, 99, 101, 102), (1, 1, 1, 1)]) == 0.0
    assert outcome(make_case, [(2, 99, 100, 101), (3, 0, 100, 101)]) == 0.0


def test_first_outcome_without_entry_price_is_a_win(make_case):
    assert outcome(make_case, [(2, 1, 2, 3)], entry=0.0) == 1.0


def test_first_outcome_depends_on_the_direction(make_case):
    rows = [(2, 40, 60, 80), (3, 99, 101, 102)]
    assert outcome(make_case, rows) == -50.0
    assert outcome(make_case, rows, order="desc") == 1.0


def test_last_offset_stands_for_rows_that_are_missing(make_case):
    rows = [(3, 99, 100, 101), (4, 99, 100, 101)]
    assert outcome(make_case, rows, order="desc", exit_price=S.LOW) == -1.099
    assert outcome(make_case, rows, order="desc", exit_price=S.LOW, last_offset=2) == 0.0
    rows = [(2, 98, 100, 101), (4, 99, 100, 101)]
    assert outcome(make_case, rows, order="desc", exit_price=S.LOW, last_offset=2) == -2.098


def array_outcome(rows, order, exit_price, stop_ratio, profit_ratio):
    """The outcome by walking a sorted array, for comparison."""
    struct = F.struct("offset", S.LOW, S.AVG, S.HIGH, F.col(exit_price).alias("out"))
    bars = F.array_sort(F.collect_list(F.when(F.col("interval_id") == 2, struct)))
    bars = F.reverse(bars) if order == "desc" else bars

    def event(bar, i):
        low, avg = bar[S.LOW], bar[S.AVG]
        closing = F.try_divide(bar["out"] * 0.999 * 100, F.col("price_in")) - 100
        return (
            F.when((low == 0) | (avg == 0), 0.0)
            .when(low <= F.col("price_in") * stop_ratio, -50.0)
            .when((bar[S.HIGH] + avg) / 2 >= F.col("price_in") * profit_ratio, 1.0)
            .when(i + 1 == F.size("bars"), closing)
            .otherwise(0.0)
        )

    keys = ["symbol", "part_name", "target_name", "target_timestamp", "price_in"]
    walked = F.filter(F.transform("bars", event), lambda x: x != 0)
    gain = half_even(F.coalesce(F.get(walked, F.lit(0)), F.lit(0.0)), 3)
    return rows.groupBy(*keys).agg(bars.alias("bars")).select(*keys[:-1], gain.alias(S.GAIN))


@pytest.mark.parametrize("order, exit_price", [("asc", S.AVG), ("desc", S.LOW)])
def test_aggregate_walk_equals_array_walk(spark, sf_dir, order, exit_price):
    rows = Q.case_rows(spark, sf_dir) if order == "asc" else Q.dense_rows(spark, sf_dir)
    settings = dict(stop_ratio=X.STOP_RATIO, profit_ratio=X.PROFIT_RATIO)
    mine = E.first_outcome(rows, order=order, exit_price=exit_price, **settings)
    other = array_outcome(rows, order, exit_price, **settings)
    mine = mine.select(other.columns)
    assert mine.exceptAll(other).isEmpty() and other.exceptAll(mine).isEmpty()


def test_best_exit(make_case):
    assert E.best_exit(make_case([(1, 1, 1, 1)])).first()[S.BEST] == 0.0
    rows = [(2, 1, 103.5, 110), (3, 1, 99, 99)]
    assert E.best_exit(make_case(rows)).first()[S.BEST] == 3.0


@pytest.mark.parametrize("usd, kept", [(49999.9, False), (50000.0, True)])
def test_liquid_cases(make_case, usd, kept):
    rows = make_case([(-1, 1, 1, 1), (0, 1, 1, 1)], usd=usd)
    assert E.liquid_cases(rows).isEmpty() != kept


def test_no_bars_up_to_the_target_is_not_liquid(make_case):
    assert E.liquid_cases(make_case([(1, 1, 1, 1)], usd=1e9)).isEmpty()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (3.0, 2.0)], ["a", "b"])
        ratio = divide(F.col("a"), F.col("b"))
        got = [str(r[0]) for r in df.select(ratio).collect()]
        assert got == ["inf", "-inf", "nan", "1.5"]
        got = [r[0] for r in df.select(floor_thousandths(ratio)).collect()]
        assert got == [None, None, None, 1.5]
        assert df.select(floor_thousandths(F.lit(1e300))).first()[0] is None
        assert df.select(half_even(F.lit(-0.0001), 2).cast("string")).first()[0] == "0.0"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_defaults_are_the_documented_constants():
    assert 1 + E.FEE == 1.001 and 1 - E.FEE == 0.999
    assert E.PROFIT_RATIO == 1.001 + 1 / 100
