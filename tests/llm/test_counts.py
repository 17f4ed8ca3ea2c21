"""Words, statistics and trees against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import quality_rules as R
from tidemark.llm import spans as S

WORD = "[^\x20\x09-\x0D]+"


def plain_counts(text):
    words = re.findall(WORD, text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            repeats += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeats, len(covered)


TEXTS = ["", None, " \n ", "a b c a b c", "x\nx\n x\nx\n", "é ñ\x0bz\x1cq", "#*$ %&|<> <", "a", "\n\n", "ab " * 500]


def test_counts_equal_plain_ones(documents):
    texts = TEXTS + [r["text"] for r in documents.collect()]
    got = R.count_texts(pa.array(texts))
    for i, text in enumerate(texts):
        assert tuple(int(got[c][i]) for c in R.COUNTS) == plain_counts(text or "")


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_words_do_not_depend_on_chunks(size):
    texts = ["one two", "", "three", None, "four five six", "é"] * 3
    words = []
    for chunk in S.chunks(pa.array(texts), size):
        starts, ends, owners = chunk.runs(S.WORD_BYTE)
        words += [
            (chunk.first + o, chunk.data[a:b].tobytes().decode()) for a, b, o in zip(starts, ends, owners)
        ]
    assert words == [(i, w) for i, t in enumerate(texts) for w in (t or "").split()]


def test_hashes_tell_stretches_apart():
    data = np.frombuffer(b"abcabcab", np.uint8)
    sums = S.running_hash(data)
    a, b, c = S.hash_between(sums, np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert a == b != c


def test_judging_odd_rows(odd, empty):
    forest = R.fit(np.zeros((0, len(R.FEATURES))), np.zeros(0), [0] * len(R.FEATURES))
    rows = R.judge(odd, forest).collect()
    assert len(rows) == odd.count()
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in rows)
    assert [r["kept"] for r in rows if r["doc_id"] in (1, 2, 3, 4, 10)] == [False] * 5
    assert R.judge(empty, forest).count() == 0


def test_kept_rows_keep_columns_with_clashing_names(odd):
    renamed = odd.withColumnRenamed("lang", "kept").withColumnRenamed("source", "_text")
    forest = R.Forest(3, 2.0)
    kept = R.keep_good(renamed, forest)
    assert kept.columns == renamed.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [9]
    assert kept.first()["kept"] == "fr" and kept.first()["_text"] == "s3"


def test_trees_keep_their_directions():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 2))
    y = (rng.random(4000) < 0.5 + 0.4 * np.sin(6 * x[:, 0]) - 0.3 * x[:, 1]).astype(float)
    forest = R.fit(x, y, [-1, 0])
    grid = np.linspace(0, 1, 200)
    for other in (0.1, 0.5, 0.9):
        scores = forest.margin(np.column_stack([grid, np.full(200, other)]))
        assert (np.diff(scores) <= 1e-12).all()
    free = R.fit(x, y, [0, 0]).margin(np.column_stack([grid, np.full(200, 0.5)]))
    assert (np.diff(free) > 0).any()


def test_held_out_documents_are_judged_right(labelled):
    documents, labels = labelled
    odd_ids, even_ids = (labels.where(f"doc_id % 2 = {k}") for k in (1, 0))
    judged = R.judge(documents, R.train(documents, odd_ids)).drop("quality")
    rows = judged.join(even_ids, "doc_id").where("NOT base_failed").collect()
    wrong = sum(r["kept"] != bool(r["quality"]) for r in rows)
    assert len(rows) > 1500 and wrong / len(rows) < 0.01
