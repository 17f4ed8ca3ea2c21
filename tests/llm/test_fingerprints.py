import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import fingerprints as P


def plain_digest(data):
    counts = [0] * P.BUCKETS
    for k, triplet in enumerate(P.TRIPLETS):
        for i in range(len(data) - triplet[-1]):
            h = k * 0x27D4EB2F & 0xFFFFFFFF
            for at, factor in zip(triplet, P._FACTORS):
                h = (h ^ data[i + at]) * factor & 0xFFFFFFFF
            counts[h >> 24] += 1
    return counts


@pytest.mark.parametrize("text", ["", "a", "ab", "abc", "abcd", "abcde", "the cat sat on the mat", "é☃" * 50])
def test_triplets_are_counted(text):
    import numpy as np

    data = text.encode()
    assert P.count_triplets(np.frombuffer(data, np.uint8)).tolist() == plain_digest(data)


def test_differences_are_bounded():
    texts = ["", "a", "some words of a text " * 20, "quite another matter altogether; " * 30, "z" * 5000]
    prints = [P.digest(t.encode()) for t in texts]
    assert prints[0] == "0" * (4 + P.BUCKETS // 2)
    for a in prints:
        for b in prints:
            assert 0 <= P.difference(a, b) <= P.MOST and P.difference(a, b) == P.difference(b, a)
            assert (P.likeness(a, b) == 1.0) == (a == b)


def test_edits_look_more_alike_than_other_documents(documents):
    rows = P.compare_edited(documents).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.95 * len(rows)


def check(frame):
    held = [(r["doc_id"], r["text"] or "") for r in frame.collect()]
    order = sorted(held, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    wanted = []
    for i, (doc_id, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        changed = P.edited(text, following)
        assert len(changed) <= len(text)
        sha = hashlib.sha256(changed.encode()).hexdigest()
        wanted.append((str(doc_id), len(text), sha, P.digest(text.encode()), P.digest(changed.encode())))
    got = [(str(r[0]), r[1], r[2], r[3], r[4]) for r in P.compare_edited(frame).collect()]
    assert sorted(got) == sorted(wanted)


@pytest.mark.parametrize("rows", [3, 50, 4000])
def test_edited_texts_over_parts(documents, monkeypatch, rows):
    from tidemark.llm import order

    monkeypatch.setattr(order, "PART_ROWS", rows)
    check(documents)


def test_odd_rows(odd, empty, spark):
    check(odd)
    check(odd.where(F.col("doc_id") == 9))
    assert P.compare_edited(empty).count() == 0
    assert P.fingerprint(odd).count() == odd.count()
