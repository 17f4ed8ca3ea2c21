import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import segmentation as G
from tidemark.llm.queries import PIECE_BPE, vocabulary_path

PATH = vocabulary_path(PIECE_BPE)


@pytest.fixture(scope="module")
def known():
    return G.vocabulary(PATH)


def plain(text, known):
    """All segmentations and their log probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    log = {int(i): x for i, x in zip(known.ids[:-1], known.logs[:-1])}
    marked = G.MARK + text.replace(" ", G.MARK) if text else ""
    found = []

    def go(at, ids, total):
        if at == len(marked):
            found.append((tuple(ids), total))
        for n in range(1, min(16, len(marked) - at) + 1):
            piece = model.piece_to_id(marked[at : at + n])
            if piece in log:
                go(at + n, [*ids, piece], total + log[piece])
            elif n == 1:
                data = marked[at].encode()
                own = [int(known.byte_ids[b]) for b in data]
                go(at + 1, ids + own, total + known.spell_byte * len(data))

    go(0, [], 0.0)
    whole = np.logaddexp.reduce([x for _, x in found])
    return {ids: x - whole for ids, x in found}


def drawn(text, n, k, known):
    lat = G.lattice([text] * n, known)
    turns, left = G.draw(lat, np.arange(n, dtype=np.uint64), k)
    out = []
    for turn in turns:
        ids, ends = G.path_ids(lat, turn.paths, n, known)
        starts = np.concatenate([[0], ends[:-1]])
        own = {int(i): tuple(ids[starts[i] : ends[i]].tolist()) for i in turn.texts}
        out.append((own, dict(zip(turn.texts.tolist(), turn.log_prob)), dict(zip(turn.texts.tolist(), turn.perturbed))))
    return out, left


@pytest.mark.parametrize("text", ["the cat", "a b", "é\n日x", "of  a", "", "x"])
def test_draws_follow_the_distribution(known, text):
    wanted, n = plain(text, known), 20_000
    chance = {ids: math.exp(x) for ids, x in wanted.items()}
    turns, left = drawn(text, n, 3, known)
    for own, logs, _ in turns:
        assert all(abs(logs[i] - wanted[own[i]]) < 1e-6 for i in list(own)[:500])
    first, second = (Counter(own.values()) for own, _, _ in turns[:2])
    for ids, p in chance.items():
        assert first[ids] / n == pytest.approx(p, abs=0.015)
        q = sum(r * p / (1 - r) for other, r in chance.items() if other != ids and r < 1 - 1e-12)
        assert second[ids] / n == pytest.approx(q, abs=0.015) or len(chance) == 1 or q > 1
    for i in range(300):
        own = [t[0][i] for t in turns if i in t[0]]
        scores = [t[2][i] for t in turns if i in t[2]]
        assert len(set(own)) == len(own) == min(3, len(chance)) and scores == sorted(scores, reverse=True)
        assert left[-1][i] <= scores[-1]


def test_perturbed_scores_are_gumbel(known):
    turns, _ = drawn("the cat", 20_000, 1, known)
    scores = np.array(list(turns[0][2].values()))
    assert scores.mean() == pytest.approx(0.5772, abs=0.05) and scores.var() == pytest.approx(np.pi**2 / 6, abs=0.1)


def test_inclusion():
    log_prob, left = np.array([-0.1, -5.0, -1000.0, -2.0]), np.array([-1.0, 0.0, 1.0, -np.inf])
    wanted = [math.log(1 - math.exp(-math.exp(0.9))), math.log(1 - math.exp(-math.exp(-5))), -1001.0, 0.0]
    assert G.log_inclusion(log_prob, left).tolist() == pytest.approx(wanted)


def test_encoding_documents(documents, odd, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = G.encode(documents, PATH, k=3, with_ids=True).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert len(rows) == 3 * len(texts) and all(r["round_trip"] for r in rows)
    assert all(model.decode(list(r["ids"])) == texts[r["doc_id"]] for r in rows)
    assert len({(r["doc_id"], tuple(r["ids"])) for r in rows}) == len(rows)
    again = G.encode(documents.repartition(7), PATH, k=3).collect()
    key = lambda r: (r["doc_id"], r["sample"], r["ids_crc32"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    held = G.encode(odd, PATH).collect()
    assert {r["sample"] for r in held if r["doc_id"] in (1, 2)} == {1}
    assert all(r["round_trip"] for r in held) and G.encode(empty, PATH).count() == 0


def test_copies_draw_their_own(spark):
    text = "several words that can be cut in many ways, internationally speaking"
    rows = [(4, text)] * 3 + [(5, text), (5, "other words"), (5, "other words"), (None, text), (None, text)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = G.encode(frame, PATH, with_ids=True, with_copies=True).collect()
    numbers = {}
    for r in found:
        numbers.setdefault((str(r["doc_id"]), r["copy"], tuple(r["ids"])), 0)
    assert sorted((r["doc_id"] or 0, r["copy"]) for r in found if r["sample"] == 1) == [
        (0, 1), (0, 2), (4, 1), (4, 2), (4, 3), (5, 1), (5, 1), (5, 2)
    ]
    drawn = {(str(r["doc_id"]), r["copy"], r["sample"]): tuple(r["ids"]) for r in found if str(r["doc_id"]) == "4"}
    assert len(set(drawn.values())) > 2
    alone = G.encode(frame.limit(1), PATH, with_ids=True).collect()
    assert [tuple(r["ids"]) for r in alone] == [drawn["4", 1, 1], drawn["4", 1, 2]]


@pytest.mark.parametrize("cuts", [[8], [1, 1, 6], [2, 0, 3, 3]])
def test_copies_are_numbered_across_batches(cuts):
    rows = [(1, "a"), (1, "a"), (1, "a"), (1, "b"), (1, "b"), (None, "b"), (None, "b"), (2, "b")]
    found, last, at = [], None, 0
    for n in cuts:
        own = rows[at : at + n]
        at += n
        batch = pa.RecordBatch.from_pydict(
            {"doc_id": pa.array([i for i, _ in own], pa.int64()), "text": pa.array([t for _, t in own], pa.string())}
        )
        numbers, last = G.copy_numbers(batch, last)
        found += numbers.tolist()
    assert found == [1, 2, 3, 1, 2, 1, 2, 1]
