"""Toxicity and importance: held-out accuracy, and defined results."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries as Q
from tidemark.llm import resampling as I
from tidemark.llm import toxicity as X
from tidemark.llm.rows import labelled_sample


def test_toxic_documents_are_found(labelled):
    documents, labels = labelled
    weights = X.train(documents, labels, where=Q.fold() != 2)
    assert len(weights.at) < 20_000
    held = labels.where(Q.fold() == 2).select("doc_id", "toxic")
    rows = X.score(documents, weights).join(held, "doc_id").collect()
    toxic = np.array([r["toxic"] for r in rows])
    score, predicted = np.array([r["score"] for r in rows]), np.array([r["predicted"] for r in rows])
    assert ((score >= 0) & (score <= 1)).all() and (predicted == (score >= 0.3)).all()
    order = score.argsort().argsort()
    area = (order[toxic == 1].mean() - (toxic.sum() - 1) / 2) / (toxic == 0).sum()
    assert area > 0.93
    assert predicted[toxic == 0].mean() < 0.01 and predicted[toxic == 1].mean() > 0.75


def test_features_of_a_text_do_not_repeat():
    rows = X.features_by_text(pa.array(["Bad bad BAD, bad", "", None, "a b c"]))
    assert [len(r) for r in rows] == [4, 1, 1, 7]  # bias; word, pair, skip; three words, two pairs, one skip
    assert all(r[0] == X.BIAS and len(set(r)) == len(r) for r in rows)


def test_scores_of_odd_rows(odd, empty, labels):
    weights = X.Weights(np.array([X.BIAS]), np.array([-1.0]))
    scores = {r["score"] for r in X.score(odd, weights).collect()}
    assert scores == {1 / (1 + np.exp(1.0))}
    assert X.score(empty, weights).count() == 0
    none = X.train(empty, labels.limit(0))
    found = X.score(odd.withColumns({"score": F.lit(1), "predicted": F.lit(1)}), none).collect()
    assert {r["predicted"] for r in found} == {0} and all(0 <= r["score"] < 0.3 for r in found)


def plain_ftrl(rows, labels, epochs, alpha, beta, l1, l2, rare):
    """Weights by the published rule, one coordinate at a time, in the rows' order."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for own, y in zip(rows, labels, strict=True):
            held = {i: weight(i) for i in own}
            p = 1 / (1 + np.exp(-sum(held.values())))
            for i in own:
                g = (p - y) * (rare if y else 1.0)
                rate = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha
                z[i] = z.get(i, 0.0) + g - rate * held[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: w for i in z if (w := weight(i))}


def test_weights_are_those_of_the_plain_rule():
    rng = np.random.default_rng(2)
    rows = [np.unique(np.concatenate([[X.BIAS], rng.integers(1, 30, 6)])) for _ in range(80)]
    labels = np.array([int(3 in r or rng.random() < 0.1) for r in rows])
    settings = dict(epochs=3, alpha=0.5, beta=1.0, l1=0.3, l2=0.01, rare=2.0)
    found = X.ftrl(rows, labels, **settings)
    wanted = plain_ftrl([r.tolist() for r in rows], labels.tolist(), **settings)
    assert {int(i): found[i] for i in np.flatnonzero(found)} == pytest.approx(wanted)


def test_held_out_is_never_null(spark, odd, labels, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = Q.queries()["op4_toxicity"](spark, str(tmp_path)).collect()
    assert len(rows) == odd.count()
    assert all(r["held_out"] is not None and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_the_sample_is_bounded_and_well_defined(spark, documents, labels):
    twice = labels.unionAll(labels.withColumn("quality", F.lit(0)))
    odd_labels = twice.unionAll(spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema))
    sample = labelled_sample(documents, odd_labels, "quality", 20)
    rows = sample.collect()
    assert len(rows) == 20 == len({r["doc_id"] for r in rows})
    assert sorted(map(tuple, rows)) == sorted(map(tuple, labelled_sample(documents, labels, "quality", 20).collect()))


def test_clean_documents_are_drawn(labelled):
    documents, labels = labelled
    ratios, share = I.train(documents, labels)
    drawn = I.resample(documents, ratios, share)
    rows = drawn.join(labels, "doc_id").collect()
    kept = {q: [r["kept"] for r in rows if r["quality"] == q] for q in (0, 1)}
    assert np.mean(kept[1]) > 0.99 and np.mean(kept[0]) < 0.1
    keys = [(r["key"], r["kept"]) for r in drawn.collect()]
    assert min(k for k, kept in keys if kept) >= max(k for k, kept in keys if not kept) - 1e-5


@pytest.mark.parametrize("k", [0, 1, 2, 5, 6, 7, 9])
def test_the_largest_places(spark, k):
    places = [5, -3, 5, 2**60, -(2**60), 5, 0]
    numbered = [(i, p, 7 - i) for i, p in enumerate(places)]
    rows = spark.createDataFrame(numbered, "doc_id bigint, place bigint, row bigint")
    got = sorted(r["doc_id"] for r in rows.where(I.largest(rows, "place", k)).collect())
    wanted = sorted(i for p, i in sorted(((-p, i) for i, p in enumerate(places)))[:k])
    assert got == wanted


def test_importance_of_odd_rows(odd, empty):
    ratios = np.ones(I.BUCKETS)
    rows = {r["doc_id"]: r for r in I.resample(odd, ratios, k=3).collect()}
    assert rows[1]["log_importance"] == rows[2]["log_importance"] == 0.0
    assert sorted(d for d, r in rows.items() if r["kept"] and d) == [8, 9][-2:] or rows[9]["kept"]
    assert I.resample(empty, ratios).count() == 0
    nothing = I.log_ratios(np.zeros(I.BUCKETS), np.ones(I.BUCKETS))
    assert not nothing.any()


@pytest.mark.parametrize("share, wanted", [(0.1, 12), (1.0, 30), (0.0, 0)])
def test_clear_target_documents_count_whole_at_small_shares(spark, share, wanted):
    clear = [(i, "some words of the target " * (1 if i else 5_000)) for i in range(10)]
    frame = spark.createDataFrame(clear + [(i, "") for i in range(10, 30)], "doc_id bigint, text string")
    drawn = I.resample(frame, np.ones(I.BUCKETS), share).collect()
    assert sum(r["kept"] for r in drawn) == wanted


@pytest.mark.parametrize("k", range(5))
def test_ties_of_rows_without_an_id(spark, k):
    frame = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, ""), (None, "a b")], "doc_id bigint, text string")
    wide = frame.withColumns({"key": F.lit(1), "place": F.lit(2), "row": F.lit(3), "kept": F.lit(4)})
    rows = I.resample(wide, np.zeros(I.BUCKETS), k=k).collect()
    assert [type(r["kept"]) for r in rows] == [bool] * 4 and sum(r["kept"] for r in rows) == k


def test_importances_are_those_of_a_plain_model(spark):
    """Ratios from counts of hashed words and pairs, summed over a text's own."""
    texts = ["good words here", "Good words, good", "bad bad", "", "words here and there"]
    ratios = np.random.default_rng(1).normal(size=I.BUCKETS)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["log_importance"] for r in I.importance(frame, ratios).collect()}
    for i, text in enumerate(texts):
        owners, buckets = I.text_buckets(next(I.S.chunks(pa.array([text]))))
        assert (owners == 0).all()
        assert found[i] == pytest.approx(sum(ratios[b] for b in buckets.tolist()))
