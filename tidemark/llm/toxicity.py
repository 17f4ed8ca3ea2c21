"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Words are runs of letters and digits, A-Z lowered. A text's features are the different single words,
pairs of neighbours and pairs with one word between them, hashed to ``2**BITS`` coordinates. Training
goes through a bounded sample of labelled documents in shards of bounded size, each in a task of its
own, with a learning rate per coordinate and an L1 penalty that leaves few weights; the shards' weights
are averaged. The sparse weights are what scoring carries to the tasks.

Defined results: a null or empty text has the score of the bias alone; repeated rows are scored each;
other columns are ignored; an empty table gives an empty result; with no labels every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans as S
from tidemark.llm.rows import by_batch, labelled_sample

BITS = 20
SAMPLE_ROWS = 24_000  # labelled documents learnt from, at most
SHARD_ROWS = 6_000  # documents learnt from in one task, about
UNLEARNT = -4.0  # margin of every text where nothing is labelled: not toxic
THRESHOLD = 0.3
BIAS = 0  # coordinate that every text has


def text_features(chunk: S.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and coordinates, with repeats, of all features of a chunk."""
    starts, ends, owners = chunk.runs(S.LETTER_BYTE)
    words = S.hash_between(S.running_hash(chunk.data, S.LOWER), starts, ends)
    pairs, at_pair = S.grams(words, owners, 2)
    skips, at_skip = S.grams(words, owners, 2, gap=1)
    hashes = np.concatenate([words, pairs, skips])
    coordinates = (S.mix(hashes) >> np.uint64(64 - BITS)).astype(np.int64)
    coordinates[coordinates == BIAS] = 1
    return np.concatenate([owners, owners[at_pair], owners[at_skip]]), coordinates


def features_by_text(texts: pa.Array) -> list[np.ndarray]:
    """For each text its different coordinates, the bias first."""
    found = []
    for chunk in S.chunks(texts):
        owners, coordinates = text_features(chunk)
        keys = np.unique(owners * (1 << BITS) + coordinates)
        at = np.searchsorted(keys >> BITS, np.arange(chunk.n + 1))
        for i in range(chunk.n):
            own = keys[at[i] : at[i + 1]] & ((1 << BITS) - 1)
            found.append(np.concatenate([[BIAS], own]))
    return found


def ftrl(
    rows: list[np.ndarray],
    labels: np.ndarray,
    epochs: int = 8,
    alpha: float = 2.0,
    beta: float = 1.0,
    l1: float = 8.0,
    l2: float = 0.0,
    rare: float = 3.0,
) -> np.ndarray:
    """Weights after some passes over the rows, in the order given.

    ``rare`` is what a row of label 1 counts against one of label 0.
    """
    z = np.zeros(1 << BITS)
    n = np.zeros(1 << BITS)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        over = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -over / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for at, y in zip(rows, labels, strict=True):
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            g *= rare if y else 1
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(slice(None))


@dataclass
class Weights:
    """The coordinates that have a weight, in order, and their weights."""

    at: np.ndarray
    weight: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 for each text."""
        dense = np.zeros(1 << BITS)
        dense[self.at] = self.weight
        margins = [np.zeros(0)]
        for chunk in S.chunks(texts):
            owners, coordinates = text_features(chunk)
            live = (dense[coordinates] != 0) & (coordinates != BIAS)
            keys = np.unique(owners[live] * (1 << BITS) + coordinates[live])
            added = np.bincount(keys >> BITS, dense[keys & ((1 << BITS) - 1)], chunk.n)
            margins.append(added + dense[BIAS])
        return 1 / (1 + np.exp(-np.clip(np.concatenate(margins), -35, 35)))


def train(
    documents: DataFrame,
    labels: DataFrame,
    bound: int = SAMPLE_ROWS,
    shard_rows: int = SHARD_ROWS,
    where: F.Column | None = None,
) -> Weights:
    """Weights from at most ``bound`` labelled documents whose ids satisfy ``where``."""
    sample = labelled_sample(documents, labels, "toxic", bound, where)
    shards = max(1, -(-min(bound, labels.count()) // shard_rows))

    def learn(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("turn", "ascending"), ("doc_id", "ascending")])
        w = ftrl(features_by_text(shard["text"]), shard["label"].to_numpy())
        at = np.flatnonzero(w)
        return pa.table({"at": pa.array(at, pa.int64()), "weight": pa.array(w[at])})

    dealt = sample.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    dealt = dealt.withColumn("turn", F.xxhash64(F.lit("order"), "doc_id"))
    learnt = dealt.groupBy("shard").applyInArrow(learn, "at bigint, weight double")
    mean = learnt.groupBy("at").agg((F.sum("weight") / shards).alias("weight"))
    rows = mean.toPandas().sort_values("at")  # at most 2**BITS, few after the L1 penalty
    if rows.empty:
        return Weights(np.array([BIAS]), np.array([UNLEARNT]))
    return Weights(rows["at"].to_numpy(np.int64), rows["weight"].to_numpy(np.float64))


def score(documents: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted (1 from ``threshold`` on) of every whole text."""

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = weights.score(batch.column("text"))
        predicted = (scores >= threshold).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores), pa.array(predicted)],
            ["doc_id", "score", "predicted"],
        )

    kind = documents.schema["doc_id"].dataType.simpleString()
    taken = documents.select("doc_id", "text")
    return taken.mapInArrow(by_batch(judge), f"doc_id {kind}, score double, predicted int")
