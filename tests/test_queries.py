"""Every registered query against its SQL, without tolerance, and the counts of the test fixture."""

import pytest

import __spark_entry__ as contract
from checks import queries as Q
from checks.compare import connect, differences
from checks.oracle import oracles
from pyspark.sql import functions as F
from tidemark import schemas as S
from tests.conftest import SF_DIR

ORACLES = oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_agrees_with_sql(spark, duck, name):
    result = Q.queries()[name](spark, SF_DIR)
    assert differences(result, duck, ORACLES[name]) == []


def test_every_query_has_sql():
    assert set(Q.queries()) == set(ORACLES)
    assert set(ORACLES) <= set(contract.oracle_sql()) and set(Q.queries()) <= set(contract.queries())


def test_a_missing_column_is_reported(spark, duck):
    result = Q.lookup_any(spark, SF_DIR).drop("offset")
    assert differences(result, duck, ORACLES["lookup_any"])


def test_entry(spark):
    assert contract.entry(spark).columns == S.TARGETS.names


@pytest.mark.parametrize(
    "scale, bars, symbols, targets, rows, outcomes",
    [
        ("0.001", 2898, 10, [76, 79, 76, 73], 233, (38, 116, 4)),
        ("0.01", 29036, 100, [816, 801, 808, 811], 2595, (417, 1380, 91)),
    ],
)
def test_fixture_counts(spark, scale, bars, symbols, targets, rows, outcomes):
    folder = f"/root/testdata/sf{scale}"
    built = Q.bars_from_trades(spark, folder)
    assert built.count() == bars
    assert built.select("symbol").distinct().count() == symbols
    per_name = Q.targets(spark, folder).groupBy("target_name").count().orderBy("target_name")
    assert [r["count"] for r in per_name.collect()] == targets
    gain = F.col(S.GAIN)
    counts = Q.training_set(spark, folder).agg(
        F.count("*"), F.count_if(gain == -50), F.count_if(gain == 1), F.count_if(gain == 0)
    )
    assert tuple(counts.first()) == (rows, *outcomes)
