import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import minhash as M


def plain_set(text, n):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def plain(rows, n=4, percent=80):
    sets = [plain_set(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            linked = common and 100 * common >= percent * len(sets[i] | sets[j])
            if linked and None not in (rows[i][0], rows[j][0]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(
        (str(d), len(sets[i]), str(least[find(i)] if d is not None else None), d is None or least[find(i)] == d)
        for i, (d, _) in enumerate(rows)
    )


def found(frame, **settings):
    return sorted((str(a), b, str(c), d) for a, b, c, d in M.near_duplicates(frame, 4, **settings).collect())


def test_sets_are_the_plain_ones():
    texts = ["a b c", "A b  c", "", None, "a b c d e", "x", "a b c d e a b c d", "é É"]
    members, ends = M.shingles(pa.array(texts), 4)
    assert np.diff(ends).tolist() == [len(plain_set(t, 4)) for t in texts]
    sets = [frozenset(members[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
    assert (sets[0] == sets[1]) and sets[6] > sets[4]


def test_signatures_are_circulant():
    members = np.array([3, 5, 8], np.uint64)
    least = M.signatures(members, np.array([0, 3]))[0]
    cells = [int(x) >> 42 for x in M.S.mix(members ^ np.uint64(0xA5A5A5A5))]
    values = np.random.default_rng(M.SEED).permutation(M.CELLS)
    assert least.tolist() == [min(values[(c + k) % M.CELLS] for c in cells) for k in range(len(least))]


def test_likeness_of_signatures():
    rng = np.random.default_rng(1)
    shared, own = rng.integers(0, 2**62, 800).astype(np.uint64), rng.integers(0, 2**62, (2, 100)).astype(np.uint64)
    a, b = (np.concatenate([shared, x]) for x in own)
    least = M.signatures(np.concatenate([a, b]), np.array([0, 900, 1800]))
    assert (least[0] == least[1]).mean() == pytest.approx(0.8, abs=0.06)
    bits = M.nibbles(least)
    unlike = sum((int(x) >> 4 * k & 15) != (int(y) >> 4 * k & 15) for x, y in zip(*bits) for k in range(16))
    assert unlike == (least[0] % 16 != least[1] % 16).sum() <= M.most_unlike(80) < 200


def near_copies(n_groups, n_copies, seed=3):
    """Texts in groups of copies that differ more or less, and texts that share a long passage."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(n_groups):
        base = [word() for _ in range(r.randint(20, 120))]
        for _ in range(n_copies):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [" ".join(passage + [word() for _ in range(r.randint(3, 40))]) for _ in range(60)]
    return [(i, t) for i, t in enumerate(r.sample(rows, len(rows)))]


@pytest.mark.parametrize("block, stretch, spokes", [(4, 6, 2), (2048, 1 << 17, 1000)])
def test_groups_equal_plain_ones(spark, monkeypatch, block, stretch, spokes):
    monkeypatch.setattr(M, "BLOCK_ROWS", block)
    monkeypatch.setattr(M, "STREAM_ROWS", stretch)
    monkeypatch.setattr(M, "SPOKES", spokes)
    rows = near_copies(12, 10)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(frame) == plain(rows)


def test_one_document_of_each_group_stays(spark, odd):
    rows = near_copies(4, 5)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = M.keep_one(frame)
    groups = M.near_duplicates(frame).where("kept").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in groups)
    named = odd.withColumnRenamed("lang", "node").withColumnRenamed("source", "_kept")
    ids = [r["doc_id"] for r in M.keep_one(named).collect()]
    assert sorted(map(str, ids)) == sorted(["1", "2", "3", "4", "5", "7", "8", "9", "10", "None"])
    assert M.keep_one(named).columns == named.columns


def test_texts_that_share_an_id_are_kept_apart(spark):
    r = random.Random(8)
    text = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(60))
    copied, alone, other, twice = text(), text(), text(), text()
    rows = [(1, copied, "a"), (5, copied + " end", "b"), (5, alone, "c"), (5, other, "d"), (7, None, "e"), (7, "", "f")]
    rows += [(8, twice, "h"), (8, twice, "g"), (8, twice + " end", "i"), (None, copied, "j")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, `a.b` string").repartition(5)
    kept = [tuple(r) for r in M.keep_one(frame).collect()]
    assert M.keep_one(frame).schema.simpleString() == frame.schema.simpleString()
    assert {c for _, _, c in kept} >= {"a", "c", "d", "j"} and not {"b", "h"} & {c for _, _, c in kept}
    assert sorted(str(d) for d, _, _ in kept) == ["1", "5", "5", "7", "8", "None"]


def test_odd_rows(odd, empty):
    assert found(odd) == plain([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert M.near_duplicates(empty).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 3), (200, 201)]
    rows = M.connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in rows} == (
        {i: 0 for i in range(41)} | {100: 90, 90: 90, 95: 90, 200: 200, 201: 200}
    )


def test_buckets_have_their_bands_number():
    least = M.signatures(np.arange(600, dtype=np.uint64) * np.uint64(977), np.array([0, 300, 600]))
    found = M.buckets(least)
    assert found.shape == (2, M.BANDS) and (found & M.BAND_MASK == np.arange(M.BANDS)).all()
    assert (M.buckets(least[:1]) == found[:1]).all() and len(np.unique(found)) > M.BANDS


def test_a_large_group_is_not_compared_with_itself(spark):
    """Of 8 000 documents of one component and 20 of others, each is dealt once."""
    rows = [(5, i, 1 if i < 8000 else 2 + i % 3, 100, 100) for i in range(8020)]
    joinable = spark.createDataFrame(rows, "bucket bigint, node bigint, component bigint, n_shingles bigint, common bigint")
    dealt = M.dealt_rows(joinable).groupBy("side").count().collect()
    # the 20 meet the large component and each other
    assert {r["side"]: r["count"] for r in dealt} == {0: 40, 1: 8000}


def test_all_pairs_of_different_components_meet(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 3)
    monkeypatch.setattr(M, "STREAM_ROWS", 5)
    rows = [(7, i, 1 if i < 23 else 2 + i % 4, 100, 100) for i in range(40)]
    joinable = spark.createDataFrame(rows, "bucket bigint, node bigint, component bigint, n_shingles bigint, common bigint")
    same = spark.createDataFrame([(i, [0] * M.BANDS, [0] * M.WORDS) for i in range(40)], "node bigint, bands array<bigint>, bits array<bigint>")
    found = {(r["a"], r["b"]) for r in M.pairs_left(joinable.withColumn("bucket", joinable.bucket - 7), same, 80).collect()}
    assert found == {(i, j) for j in range(40) for i in range(j) if rows[i][2] != rows[j][2]}


def test_folders_are_deleted_once_used(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    frame = spark.createDataFrame(near_copies(4, 6), "doc_id bigint, text string")
    before = set(folder.iterdir())
    M.near_duplicates(frame, 4).collect()
    assert len(set(folder.iterdir()) - before) <= 11


def test_texts_come_in_batches_of_bounded_size(spark, monkeypatch):
    """Of long texts, no step works on as many at once as of short ones."""
    whole = M.shingles

    def bounded(texts, n):
        if texts.nbytes > 1 << 16:
            raise ValueError(f"{texts.nbytes} bytes of text at once")
        return whole(texts, n)

    monkeypatch.setattr(M, "shingles", bounded)
    monkeypatch.setattr(M, "TEXT_BYTES", 1 << 14, raising=False)
    rows = near_copies(20, 40)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert sum(len(t) for _, t in rows) > 1 << 18
    assert found(frame) == plain(rows)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None


def test_a_batch_size_of_the_session_stays(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(name, "12345")
    try:
        assert M.stored(spark.range(3), 99).count() == 3
        assert spark.conf.get(name) == "12345"
    finally:
        spark.conf.unset(name)
