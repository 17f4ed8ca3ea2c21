"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import spelling as V


def is_near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counts(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode()) if doc is not None else 1
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def plainly(rows):
    n = counts(rows)
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    result = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        result.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(result)


def rows(found):
    return sorted(tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect())


def corpus(seed):
    r = random.Random(seed)
    stems = ["".join(r.choice("abeé") for _ in range(r.randint(5, 9))) for _ in range(60)]
    text = lambda: " ".join(stems[min(int(r.expovariate(0.1)), 59)].title() for _ in range(r.randint(0, 80)))
    chain = "chains " * 6 + "chainsa " * 45 + "chainsab " * 300
    return [(i, text()) for i in range(150)] + [(900, chain), (None, text()), (3, None), (4, ""), (5, "1 2"), (5, "1 2")]


@pytest.mark.parametrize("group_words", [2, 512])
def test_variants_are_those_of_a_plain_comparison(spark, group_words):
    texts = corpus(1)
    wanted = plainly(texts)
    assert any(w[1] for w in wanted) and any(w[1] != w[2] and w[1] for w in wanted)
    documents = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert rows(V.variants(documents, group_words=group_words)) == wanted


WORDS = st.lists(st.text("abé", min_size=5, max_size=8), min_size=2, max_size=25, unique=True)


@settings(max_examples=80, deadline=None)
@given(WORDS)
def test_tiles_find_all_pairs_once(words):
    n = np.arange(1, len(words) + 1)
    for m in range(5, 10):
        own = [i for i, w in enumerate(words) if len(w) in (m, m - 1)]
        held = [words[i] for i in own]
        if not held:
            continue
        total = Counter()
        for low, high in ((0, m // 2), (m // 2 + 1, m - 1)):
            order, count, best, best_n = V._near_in_group(held, n[own], m, low, high)
            for i, c in zip(order.tolist(), count.tolist(), strict=True):
                total[held[i]] += c
        for w in held:
            near = [v for v in held if is_near(w, v) and max(len(w), len(v)) == m]
            assert total[w] == len(near)


@pytest.mark.parametrize("cells", [1, 200])
def test_blocks_do_not_change_what_is_near(monkeypatch, cells):
    r = random.Random(2)
    words = sorted({"".join(r.choice("ab") for _ in range(r.choice([7, 8]))) for _ in range(120)})
    whole = V._near_in_group(words, np.arange(len(words)), 8, 0, 7)
    monkeypatch.setattr(V, "TILE_CELLS", cells)
    parts = V._near_in_group(words, np.arange(len(words)), 8, 0, 7)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_slips_of_long_runs(spark):
    long = "é" * 300 + "x" * 5000
    texts = [(i, f"{long} {long}y") for i in range(900)]
    documents = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert {r["word"]: r["n"] for r in V.vocabulary(documents).collect()} == counts(texts)


def test_groups_are_halved_until_they_are_small(spark):
    r = random.Random(4)
    words = sorted({"same" + "".join(r.choice("ab") for _ in range(8)) + "ends" for _ in range(500)})
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint")
    found = V.groups(frame, most=8)
    assert len(found) > 2
    for part in found:
        sizes = part.groupBy("m", "low", "high", "key").agg(F.count("*").alias("held"))
        assert sizes.where("held > 8 AND low < high").isEmpty()


def test_odd_rows(spark, odd, empty):
    texts = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert rows(V.variants(odd.withColumns({"word": F.lit(1), "n": F.lit(2)}))) == plainly(texts)
    found = V.variants(empty)
    assert found.count() == 0
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
