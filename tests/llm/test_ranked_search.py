"""Ranked search against exhaustive scoring."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ranked_search as R
from tidemark.llm import terms

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]


def plainly(documents, items, k=10):
    held = [(d, Counter(words(t))) for d, t in documents]
    held = [(d, c) for d, c in held if c]
    n, length = len(held), sum(c.total() for _, c in held)
    df = Counter(w for _, c in held for w in c)
    result = []
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(words(text))
    for item, own in queries.items():
        scored = []
        for d, c in held:
            m = 10 + (90 * c.total() * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                for w in own
                if c[w]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        scored.sort(key=lambda x: x[:3])
        result += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(scored[:k])]
    return sorted(map(repr, result))


def rows(found):
    return sorted(repr(tuple(r)) for r in found.select("item_id", "rank", "doc_id", "score").collect())


def corpus(seed, n, width):
    r = random.Random(seed)
    common = [f"w{i}" for i in range(width)]
    text = lambda: " ".join(common[min(int(r.expovariate(0.3)), width - 1)] for _ in range(r.randint(0, 40)))
    documents = [(i // 2 if i % 7 == 0 else i, text()) for i in range(n)]
    items = [(i, text()) for i in range(12)] + [(3, text()), (None, text())]
    return documents, items


@pytest.mark.parametrize("first_read, postings", [(64, 10**9), (1, 500), (3, 1)])
def test_search_is_exhaustive_scoring(spark, monkeypatch, first_read, postings):
    monkeypatch.setattr(R, "FIRST_READ", first_read)
    monkeypatch.setattr(R, "SHARD_POSTINGS", postings)
    documents, items = corpus(first_read, 600, 30)
    found = R.search(
        spark.createDataFrame(documents, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    assert rows(found) == plainly(documents, items)


def index(lists):
    """An index of documents 0, 1, ... from {term: {document: impact}}."""
    docs, impacts, cuts = [], [], [0]
    for held in lists:
        for d, x in sorted(held.items(), key=lambda p: -p[1]):
            docs.append(d)
            impacts.append(x)
        cuts.append(len(docs))
    n = max(docs) + 1
    as_array = lambda x: pa.array(x, pa.int64()).to_numpy()
    return R.Index(as_array(docs), as_array(impacts), as_array(cuts), as_array(range(n)), as_array([0] * n))


def test_reading_stops_where_bounds_are_settled(monkeypatch):
    monkeypatch.setattr(R, "FIRST_READ", 2)
    best = {d: 1000 - d for d in range(3)}
    lists = [best | {d: 5 for d in range(3, 500)}, best | {d: 4 for d in range(3, 500)}]
    reads = []
    kept = index(lists)

    class Watched:
        def __getitem__(self, at):
            if isinstance(at, slice):
                reads.append(at.stop - at.start)
            return kept.documents[at]

    watched = R.Index(Watched(), kept.impacts, kept.cuts, kept.ids, kept.unnamed)
    docs, scores = R.read_best(watched, pa.array([0, 1]).to_numpy(), 3)
    assert docs.tolist() == [0, 1, 2] and scores.tolist() == [2000, 1998, 1996]
    assert sum(reads) < 50


def test_ties_fall_to_the_smaller_id(monkeypatch):
    monkeypatch.setattr(R, "FIRST_READ", 1)
    lists = [{d: 7 for d in range(50)}, {d: 7 for d in range(25, 50)}]
    docs, scores = R.read_best(index(lists), pa.array([0, 1]).to_numpy(), 30)
    assert docs.tolist() == [*range(25, 50), *range(5)] and set(scores.tolist()) == {14, 7}


def test_odd_rows(spark, odd, empty):
    items = [(1, "same words Here ONE"), (2, None), (3, ""), (4, "é 日本 w5 w6"), (None, "null id"), (1, "x"), (5, "x" * 30_000)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    texts = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    found = R.search(odd.withColumns({"rank": F.lit(1), "score": F.lit(2)}), benchmark)
    assert rows(found) == plainly(texts, items)
    assert R.search(empty, benchmark).count() == 0
    assert R.search(odd, benchmark.where("false")).count() == 0


def test_blocks_give_the_same_rows(spark, documents, monkeypatch):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = rows(R.search(documents, benchmark))
    blocks = terms.blocks
    monkeypatch.setattr(terms, "blocks", lambda found, key: blocks(found, key, 4000))
    assert rows(R.search(documents, benchmark)) == whole
