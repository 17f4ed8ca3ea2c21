import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import repeats as R
from tidemark.llm import suffixes as X


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60), st.sampled_from([1, 500]))
def test_suffix_arrays(symbols, scale):
    s = np.array([*(x * scale for x in symbols), 0])
    sa = X.suffix_array(s)
    wanted = sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert sa.tolist() == wanted
    before, common = X.permuted_common_prefixes(s, sa, np.array([0]), len(s))
    for a, b in zip(wanted, wanted[1:]):
        n = 0
        while max(a, b) + n < len(s) and s[a + n] == s[b + n]:
            n += 1
        assert before[b] == a and common[b] == n


def plain(rows):
    """The contract, string by string."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        key = (doc_id is None, doc_id or 0)
        for i in range(len(data) - 99):
            at = (key, i)
            first[data[i : i + 100]] = min(at, first.get(data[i : i + 100], at))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        key, gone = (doc_id is None, doc_id or 0), bytearray(len(data))
        for i in range(len(data) - 99):
            if first[data[i : i + 100]] < (key, i):
                gone[i : i + 100] = b"\1" * 100
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(b for b, g in zip(data, gone) if not g)
        out.append((str(doc_id), len(data), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out)


def found(frame):
    return sorted((str(r[0]), *r[1:]) for r in R.repeats(frame).collect())


def passages(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 5)))
    shared = [" ".join(word() for _ in range(r.randint(20, 80))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(r.randint(0, 30))) for _ in range(r.randint(1, 3))]
        for _ in range(r.randint(0, 3)):
            passage = r.choice(shared)
            cut = r.randrange(len(passage) // 2)
            parts.insert(r.randrange(len(parts) + 1), passage[cut:])
        rows.append((i, " ".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1][5:]), (102, "ab" * 300), (103, "ab" * 290 + "c"), (104, "q" * 99)]
    return rows


@pytest.mark.parametrize("seed, segments", [(1, 20_000), (2, 2)])
def test_removal_equals_the_plain_one(spark, monkeypatch, seed, segments):
    monkeypatch.setattr(R, "SHARD_SEGMENTS", segments)
    rows = passages(seed)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(frame) == plain(rows)


def test_documents(documents):
    assert found(documents) == plain([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_odd_rows(odd, empty, spark):
    assert found(odd) == plain([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert R.repeats(empty).count() == 0
    named = odd.withColumnRenamed("lang", "kept").withColumnRenamed("source", "id")
    left = R.without_repeats(named)
    assert left.columns == named.columns and left.count() == named.count()


def test_texts_lose_what_repeats(spark):
    r = random.Random(4)
    passage = "".join(r.choice("abcdefghijk") for _ in range(150)) + "é"
    rows = [(1, "first " + passage), (2, "second " + passage[:-1] + "è end"), (3, "é" + passage[:30])]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["doc_id"]: r["text"] for r in R.without_repeats(frame).collect()}
    assert got[1] == rows[0][1] and got[3] == rows[2][1]
    assert got[2] == "second end"  # the blank before the passage repeats, and the first half of è


def test_segments_alike_in_half_their_hash_are_not_equal(monkeypatch):
    r = random.Random(5)
    letters = lambda n: "".join(r.choice("abcdefghijk") for _ in range(n))
    passage = letters(130)
    texts = [letters(150) + passage + letters(150) for _ in range(40)]
    real = R.segments

    def alike(chunk):
        *rest, hashes = real(chunk)
        return (*rest, hashes & np.uint64(0xFFFFFFFF))

    monkeypatch.setattr(R, "segments", alike)
    columns = [pa.array(range(40)), pa.array(range(40)), pa.array(texts)]
    batch = pa.RecordBatch.from_arrays(columns, ["id", "tid", "text"])
    inside = lambda spot: (  # noqa: E731  # only strings that lie wholly in the passage repeat
        R.start_of(spot) >= 150 and R.start_of(spot) + R.count_of(spot) - 1 + R.LENGTH <= 150 + len(passage)
    )
    together = next(R.found_segments(iter([batch])))
    assert all(inside(s) for s in together["spot"].to_pylist() if s & R._KNOWN)
    dealt = pa.Table.from_batches([next(R.found_segments(iter([batch.slice(i, 1)]))) for i in range(40)])
    dealt = dealt.combine_chunks().sort_by([(c, "ascending") for c in dealt.column_names])
    sifted = next(R.sift_segments(iter(dealt.to_batches()))).to_pylist()
    assert sum(row["open"] for row in sifted) >= 40
    assert all(inside(row["spot"]) for row in sifted if not row["open"])


def test_strings_that_many_share_meet_folded(spark, monkeypatch):
    r = random.Random(6)
    letters = lambda n: "".join(r.choice("abcdefghijk") for _ in range(n))
    passage = letters(130)
    rows = [(i if i % 9 else None, letters(110) + passage + letters(110)) for i in range(120)]
    rows += [(3, letters(40) + passage), (3, letters(40) + passage + letters(9)), (1, letters(110) + passage)]
    monkeypatch.setattr(R, "SHARD_SEGMENTS", 20)
    real = R.sort_shards

    def watched(batches):
        def seen():
            met = Counter()
            for batch in batches:
                names = [c for c in batch.schema.names if c in ("anchor", "shard")]
                met.update(zip(*(batch.column(c).to_pylist() for c in names)))
                assert not met or max(met.values()) <= 60
                yield batch

        return real(seen())

    monkeypatch.setattr(R, "sort_shards", watched)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(frame) == plain(rows)


def periodic(seed):
    """Runs and short periods, with something else in between, and parts of them in other texts."""
    r = random.Random(seed)
    rows = []
    for i in range(12):
        parts = []
        for _ in range(r.randint(1, 5)):
            period = "".join(r.choice("ab é\n") for _ in range(r.choice([1, 1, 2, 3, 7, 40])))
            parts.append(period * r.randint(1, 700 // len(period)))
            parts.append("".join(r.choice("abcdefgh") for _ in range(r.choice([0, 3, 60, 150]))))
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed, piece", [(1, (1 << 21) - 1), (2, 150), (3, 333)])
def test_runs_and_periods_in_pieces(spark, monkeypatch, seed, piece):
    monkeypatch.setattr(R, "PIECE_BYTES", piece)
    rows = periodic(seed)
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)) == plain(rows)


@pytest.mark.parametrize("period", ["x", " ", "abc", "0123456789" * 4])
def test_long_runs_take_few_rows(period):
    text = period * (8_000_000 // len(period))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([text])], ["id", "tid", "text"])
    rows = next(R.found_segments(iter([batch])))
    assert rows.num_rows < 3_000
    spots = [s for s in rows["spot"].to_pylist() if s & R._KNOWN]
    covered = sum(int(R.long_count_of(np.int64(s))) for s in spots)
    assert len(text) - 99 - covered < 3_000


def test_a_long_run_in_a_table(spark):
    n = 5_000_000
    frame = spark.createDataFrame([(1, "x" * n), (2, "y" * 150 + "x" * 400), (3, " " * n)], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in R.repeats(frame).collect()}
    assert (rows[1]["n_removed"], rows[1]["n_spans"]) == (n - 1, 1)
    assert rows[1]["kept_sha256"] == hashlib.sha256(b"x").hexdigest()
    assert (rows[3]["n_removed"], rows[3]["n_spans"]) == (n - 1, 1)
    assert rows[2]["n_removed"] == 149 + 400  # every y but the first, and all x


def test_anchors_do_not_depend_on_what_is_around():
    r = random.Random(9)
    passage = "".join(r.choice("abcd ") for _ in range(400))
    around = ["", "z" * 5, "".join(r.choice("efgh") for _ in range(300_000))]
    seen = []
    for before in around:
        chunk = next(R.S.chunks(pa.array([before + passage])))
        text, start, place, count, anchor, hashes = R.segments(chunk)
        inside = start >= len(before)
        seen.append(list(zip(start[inside] - len(before), place[inside], count[inside], anchor[inside])))
    assert set(seen[0][1:]) <= set(seen[1]) and set(seen[0][1:]) <= set(seen[2])
