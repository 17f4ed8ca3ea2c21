import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture as X
from checks import queries as Q
from tests.conftest import DAY
from tidemark import Grid
from tidemark import schemas as S
from tidemark.plans.backfill import Tables, backfill, daily, load_bars, refresh, refresh_changed, spans
from tidemark.sources import tsv
from tidemark.sources.tables import read_table, replace_parts, truncate
from tidemark.sources.tsv import read_tsv, write_tsv
from tidemark.streaming.arrivals import affected, process_new_bars

D1, D2, D3 = date(2023, 2, 1), date(2023, 2, 2), date(2023, 2, 3)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def frame(spark, rows):
    records = [
        ("price_increase_1", symbol, part, datetime(part.year, part.month, part.day, 1), value)
        for symbol, part, value in rows
    ]
    return spark.createDataFrame(records, S.TARGETS)


def stored_rows(spark, path):
    rows = read_table(spark, path, S.TARGETS).select("symbol", "part_name", "value").collect()
    return sorted(map(tuple, rows))


def replace(df, path, first, last):
    replace_parts(df, path, first, last, S.TARGETS, S.TARGET_KEY)


def test_replace_parts(spark, path):
    replace(frame(spark, [("A", D1, 1.0), ("A", D2, 2.0), ("A", D3, 3.0)]), path, D1, D3)
    replace(frame(spark, [("B", D2, 5.0)]), path, D2, D2)
    assert stored_rows(spark, path) == [("A", D1, 1.0), ("A", D3, 3.0), ("B", D2, 5.0)]


def test_replace_parts_empties_parts_without_rows(spark, path):
    replace(frame(spark, [("A", D1, 1.0), ("A", D2, 2.0), ("A", D3, 3.0)]), path, D1, D3)
    replace(frame(spark, [("B", D1, 5.0)]), path, D1, D2)
    assert stored_rows(spark, path) == [("A", D3, 3.0), ("B", D1, 5.0)]
    replace(frame(spark, [("B", D2, 6.0)]), path, D2, D2)
    assert stored_rows(spark, path) == [("A", D3, 3.0), ("B", D1, 5.0), ("B", D2, 6.0)]


def test_replace_parts_writes_only_the_range(spark, path):
    replace(frame(spark, [("A", D1, 1.0), ("A", D2, 2.0), ("A", D3, 3.0)]), path, D2, D2)
    assert stored_rows(spark, path) == [("A", D2, 2.0)]


def test_replace_parts_of_nothing(spark, path):
    replace(frame(spark, []), path, D1, D3)
    assert stored_rows(spark, path) == []


def test_replace_parts_does_not_ask_the_clock(spark, path, monkeypatch):
    class Late(datetime):
        @classmethod
        def now(cls, tz=None):
            return datetime(2001, 1, 1, tzinfo=tz)

    replace(frame(spark, [("A", D1, 1.0), ("A", D2, 2.0)]), path, D1, D2)
    monkeypatch.setattr("tidemark.sources.tables.datetime", Late)
    replace(frame(spark, [("B", D1, 5.0)]), path, D1, D2)
    assert stored_rows(spark, path) == [("B", D1, 5.0)]


def test_rows_carry_the_version_of_their_write(spark, path):
    replace(frame(spark, [("A", D1, 1.0)]), path, D1, D1)
    first = read_table(spark, path, S.TARGETS, version=True).first()["row_version"]
    replace(frame(spark, [("A", D1, 1.0)]), path, D1, D1)
    assert read_table(spark, path, S.TARGETS, version=True).first()["row_version"] > first


def test_truncate(spark, path):
    replace(frame(spark, [("A", D1, 1.0), ("A", D2, 2.0)]), path, D1, D2)
    truncate(spark, path, S.TARGETS)
    after = read_table(spark, path, S.TARGETS)
    assert after.isEmpty() and after.schema == S.TARGETS
    replace(frame(spark, [("A", D1, 7.0)]), path, D1, D1)
    assert stored_rows(spark, path) == [("A", D1, 7.0)]


def test_tsv_round_trip(spark, path):
    schema = T.StructType(
        [
            T.StructField("n", T.LongType()),
            T.StructField("x", T.DoubleType()),
            T.StructField("text", T.StringType()),
            T.StructField("day", T.DateType()),
            T.StructField("at", T.TimestampNTZType()),
            T.StructField("yes", T.BooleanType()),
        ]
    )
    texts = ["plain", "", None, " padded ", "a\tb", "a\nb\r\nc", "\\N", "\\t", "back\\"]
    texts += ['"', '"a\tb"', "é☃", "\\\\n", "#c"]
    rows = [
        (i, i / 3, text, D1, datetime(2023, 1, 1, 1, 2, 3, 456000), True)
        for i, text in enumerate(texts)
    ] + [(None, None, "none", None, None, None), (99, 1e300, "big", D2, DAY, False)]
    df = spark.createDataFrame(rows, schema)
    write_tsv(df, path)
    back = read_tsv(spark, path, schema)
    assert back.schema == schema
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_tsv_keeps_control_characters(spark, path):
    texts = [chr(i) for i in range(128)] + [f"a{chr(i)}b" for i in range(32)] + ["\\0", "\0", "\\\0\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    write_tsv(df, path)
    assert sorted(map(tuple, read_tsv(spark, path, df.schema).collect())) == list(enumerate(texts))


def test_tsv_finds_columns_by_name(spark, path):
    write_tsv(spark.createDataFrame([("x", 1, True)], "b string, a int, c boolean"), path)
    wanted = spark.createDataFrame([], "a int, b string").schema
    assert tuple(read_tsv(spark, path, wanted).first()) == (1, "x")
    with pytest.raises(ValueError, match="lacks d"):
        read_tsv(spark, path, spark.createDataFrame([], "a int, d string").schema)


def test_tsv_never_writes_blank_lines(spark, path):
    texts = spark.createDataFrame([("a",), (None,)], "text string")
    write_tsv(texts, path)
    assert read_tsv(spark, path, texts.schema).count() == 2
    with pytest.raises(Exception, match="would be lost"):
        write_tsv(spark.createDataFrame([("a",), ("",)], "text string"), path)


def test_tsv_has_a_header_row(spark, path):
    write_tsv(spark.createDataFrame([(1, "a")], "n int, text string").coalesce(1), path)
    assert [r[0] for r in spark.read.text(path).collect()] == ["n\ttext", "1\ta"]


def test_spans():
    grid = Grid()
    assert list(spans(D1, D3, grid, None)) == [(D1, D3)]
    assert list(spans(D1, D3, grid, 2)) == [(D1, D2), (D3, D3)]
    weeks = Grid(bar=timedelta(days=7), origin=datetime(1995, 1, 2), part_days=364)
    start = date(1995, 1, 2)
    year = timedelta(days=364)
    assert list(spans(start, start + 2 * year, weeks, 2)) == [
        (start, start + year),
        (start + 2 * year, start + 2 * year),
    ]


def test_affected_parts():
    day = timedelta(days=1)
    assert affected([D1], Grid()) == [(D1, D2)]
    assert affected([D3, D1], Grid()) == [(D1, D3 + day)]
    late = D3 + 5 * day
    assert affected([D1, late], Grid()) == [(D1, D2), (late, late + day)]


def minute_bars(make_bars):
    prices = [("A", m, 100.0) for m in range(-400, 0)]
    return make_bars(prices + [("A", 0, 102.0)] + [("A", m, 102.0) for m in range(1, 80)])


def tables(tmp_path, name):
    return Tables(*[str(tmp_path / name / t) for t in ("bars", "targets", "training")])


def contents(spark, where):
    bars = read_table(spark, where.bars, S.BARS)
    training = read_table(spark, where.training, S.TRAINING)
    frames = (bars, where.read_targets(spark), training)
    return [sorted(map(repr, f.collect())) for f in frames]


def test_daily_backfill_and_arrivals_agree(spark, tmp_path, make_bars):
    bars = minute_bars(make_bars)
    by_day, at_once, arriving = (tables(tmp_path, n) for n in ("days", "once", "stream"))
    for day in (D1, D2):
        daily(spark, bars, by_day, day + timedelta(days=1))
    load_bars(bars, at_once, D1, D2)
    refresh(spark, at_once, D1, D2)
    for day in (D1, D2):
        load_bars(bars, arriving, day, day)
        process_new_bars(spark, arriving, str(tmp_path / "progress"))
    expected = contents(spark, at_once)
    assert [len(rows) for rows in expected] == [480, 30, 4]
    assert contents(spark, by_day) == expected
    assert contents(spark, arriving) == expected


def test_old_bar_files_are_not_passed_over(spark, tmp_path, make_bars):
    where = tables(tmp_path, "old")
    load_bars(minute_bars(make_bars), where, D1, D2)
    year_ago = (DAY - timedelta(days=365)).timestamp()
    for file in (tmp_path / "old" / "bars" / f"date={D2.isoformat()}").iterdir():
        os.utime(file, (year_ago, year_ago))
    process_new_bars(spark, where, str(tmp_path / "progress"))
    assert where.read_targets(spark).where(F.col("part_name") == F.lit(D2)).count() == 30


def test_backfill_builds_every_run(spark, path):
    asked = []

    def build(first, last):
        asked.append((first, last))
        return frame(spark, [("A", first, 1.0), ("A", last, 2.0)])

    backfill(build, path, D1, D3, Grid(), S.TARGETS, S.TARGET_KEY, parts_per_job=2)
    assert asked == [(D1, D2), (D3, D3)]
    assert len(stored_rows(spark, path)) == 4


def test_reading_one_part_reads_one_directory(spark, path):
    replace(frame(spark, [("A", D1, 1.0), ("A", D2, 2.0)]), path, D1, D2)
    one = read_table(spark, path, S.TARGETS).where(F.col("part_name") == F.lit(D2))
    assert one.select("value").inputFiles() != [] and len(one.collect()) == 1


def test_tsv_files_of_different_headers(spark, path):
    """Swapped columns, a column more, an empty file, and values that look like a header."""
    rows = spark.createDataFrame([(i, f"a\t{i}", float(i)) for i in range(40)], "i int, t string, x double")
    write_tsv(rows.where("i < 20"), f"{path}/one")
    write_tsv(rows.where("i >= 20").select("x", F.lit("more").alias("other"), "i", "t"), f"{path}/two")
    for mode in (1000, 0):
        before = tsv.HEADER_FILES
        tsv.HEADER_FILES = mode
        try:
            found = read_tsv(spark, f"{path}/*", rows.schema)
            assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))
        finally:
            tsv.HEADER_FILES = before
    write_tsv(rows.select("i", "t"), f"{path}/three")
    with pytest.raises(ValueError, match="lacks x"):
        read_tsv(spark, f"{path}/*", rows.schema)


def test_tsv_of_no_files(spark, path):
    write_tsv(spark.createDataFrame([], "i int"), path)
    assert read_tsv(spark, path, T.StructType([T.StructField("i", T.IntegerType())])).count() == 0


def fixture_tables(folder, digests=False, bucket=Q.PART_BUCKET):
    return Tables(
        f"{folder}/bars", f"{folder}/targets", f"{folder}/training", X.GRID,
        target_settings=(("horizons", X.HORIZONS), ("lookback", X.LOOKBACK), ("bucket", bucket)),
        training_settings=(("before", X.BEFORE), ("after", X.AFTER)),
        digests=f"{folder}/digests" if digests else None,
    )


def table_rows(spark, tables):
    found = read_table(spark, tables.training, S.TRAINING).collect()
    return sorted(map(repr, tables.read_targets(spark).collect())), sorted(map(repr, found))


def test_a_stopped_backfill_repeats_only_open_runs(spark, sf_dir, tmp_path, monkeypatch):
    tables, log = fixture_tables(tmp_path / "t"), str(tmp_path / "log")
    first, last = X.part_range(spark, sf_dir)
    load_bars(X.bars(spark, sf_dir), tables, first, last)
    built = []
    build = Tables.build_training

    def failing(self, session, a, b):
        built.append((a, b))
        if len(built) == 3:
            raise RuntimeError("stopped")
        return build(self, session, a, b)

    monkeypatch.setattr(Tables, "build_training", failing)
    with pytest.raises(RuntimeError):
        refresh(spark, tables, first, last, 2, log)
    monkeypatch.setattr(Tables, "build_training", build)
    runs = list(spans(first, last, X.GRID, 2))
    assert len(runs) > 3 and built == runs[:3]
    assert refresh(spark, tables, first, last, 2, log) == runs[2:]  # of the training set alone
    assert refresh(spark, tables, first, last, 2, log) == []
    whole = fixture_tables(tmp_path / "whole")
    load_bars(X.bars(spark, sf_dir), whole, first, last)
    refresh(spark, whole, first, last)
    assert table_rows(spark, tables) == table_rows(spark, whole)
    # new bars of a part, or a table that was spoilt, open their runs again
    load_bars(X.bars(spark, sf_dir), tables, runs[1][0], runs[1][0])
    again = refresh(spark, tables, first, last, 2, log)
    assert again == [runs[1], runs[1]]
    truncate(spark, tables.targets, S.TARGETS)
    assert refresh(spark, tables, first, last, 2, log) == [*runs, *runs]
    assert table_rows(spark, tables) == table_rows(spark, whole)


@pytest.mark.parametrize("bucket", [Q.PART_BUCKET, X.BUCKET])
def test_a_late_symbol_recomputes_one_symbol(spark, sf_dir, tmp_path, bucket):
    """Only what a changed symbol touches is worked out again, and the tables are those of a whole rebuild."""
    bars = X.bars(spark, sf_dir).cache()
    first, last = X.part_range(spark, sf_dir)
    length = timedelta(days=X.GRID.part_days)
    late, part = bars.first()["symbol"], first + 3 * length
    is_late = (F.col("symbol") == late) & (F.col("date") == F.lit(part))
    tables, progress = fixture_tables(tmp_path / "t", digests=True, bucket=bucket), str(tmp_path / "progress")
    load_bars(bars.where(~is_late), tables, first, last)
    process_new_bars(spark, tables, progress)
    before = read_table(spark, tables.targets, S.TARGETS, version=True).collect()
    changed = refresh_changed(spark, tables, first, last)
    assert changed.isEmpty()
    assert sorted(map(repr, read_table(spark, tables.targets, S.TARGETS, version=True).collect())) == sorted(map(repr, before))
    load_bars(bars, tables, part, part)  # all symbols of the part are written again, one of them differs
    assert [tuple(r) for r in refresh_changed(spark, tables, part, part).collect()] == [(late, part)]
    whole = fixture_tables(tmp_path / "whole", bucket=bucket)
    load_bars(bars, whole, first, last)
    refresh(spark, whole, first, last)
    assert table_rows(spark, tables) == table_rows(spark, whole)
    # a symbol that vanishes takes its rows along
    load_bars(bars.where(~is_late), tables, part, part)
    process_new_bars(spark, tables, progress)
    load_bars(bars.where(~is_late), whole, part, part)
    refresh(spark, whole, first, last)
    assert table_rows(spark, tables) == table_rows(spark, whole)
