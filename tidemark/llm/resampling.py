"""Quality classifier by importance resampling over hashed n-grams.

Two bag models are counted over ``BUCKETS`` hashed single words and word pairs: one of the target, the
documents labelled good, and one of the raw text, all documents. A document's log importance is the sum
over its n-grams of the log ratio of both. Documents are drawn without replacement, in proportion to
their importance, by adding a Gumbel number to it and taking the largest: as many as the importances say
come from the target.

The raw counts cover every document and are summed within each task before they meet. The target is
counted on a bounded sample of labelled documents. The k-th largest key is found by counting keys by
their leading bits, sixteen more in each round, so no task orders or holds all keys.

Defined results: a null or empty text has importance 0; repeated rows get the same key; ties at the last
place are broken by doc_id, then left to equal rows alike; an empty table gives an empty result; without
good labels all importances are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans as S
from tidemark.llm.rows import by_batch, labelled_sample, stored

BUCKETS = 1 << 16
SAMPLE_ROWS = 20_000  # labelled documents that the target model is counted on, at most
SMOOTHING = 200.0  # n-grams that a bucket must expect before its own counts outweigh the raw share
MOST_EXPONENT = 700.0  # of a larger one, the importance would not be a finite double
SEED = "resample"


def text_buckets(chunk: S.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and buckets of all n-grams: runs of letters or of other characters, and pairs."""
    mark = ~S.LETTER_BYTE & S.WORD_BYTE
    parts = [chunk.runs(member) for member in (S.LETTER_BYTE, mark)]
    starts, ends, owners = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(starts, kind="stable")
    starts, ends, owners = starts[order], ends[order], owners[order]
    words = S.hash_between(S.running_hash(chunk.data), starts, ends)
    pairs, at = S.grams(words, owners, 2)
    buckets = (S.mix(np.concatenate([words, pairs])) >> np.uint64(48)).astype(np.int64)
    return np.concatenate([owners, owners[at]]), buckets


def counted(texts: DataFrame) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for chunk in S.chunks(batch.column("text")):
                totals += np.bincount(text_buckets(chunk)[1], minlength=BUCKETS)
        filled = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int64()), pa.array(totals[filled])], ["bucket", "n"]
        )

    found = texts.select("text").mapInArrow(run, "bucket bigint, n bigint")
    rows = found.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows at most
    totals = np.zeros(BUCKETS)
    totals[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return totals


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket, the log of its probability under the target over that under the raw text."""
    if not target.sum():
        return np.zeros(BUCKETS)
    expected = raw * (target.sum() / raw.sum())
    return np.log(target + SMOOTHING) - np.log(expected + SMOOTHING)


def train(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Log ratios by bucket, and the share of good documents among the labelled ones."""
    sample = stored(labelled_sample(documents, labels, "quality", bound))
    share = sample.agg(F.avg("label")).first()[0]
    good = counted(sample.where("label = 1"))
    return log_ratios(good, counted(documents)), 1.0 if share is None else share


def importance(documents: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id and log_importance of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums = [np.zeros(0)]
        for chunk in S.chunks(batch.column("text")):
            owners, buckets = text_buckets(chunk)
            sums.append(np.bincount(owners, ratios[buckets], chunk.n))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.concatenate(sums))], ["doc_id", "log_importance"]
        )

    kind = documents.schema["doc_id"].dataType.simpleString()
    taken = documents.select("doc_id", "text")
    return taken.mapInArrow(by_batch(run), f"doc_id {kind}, log_importance double")


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """A Gumbel number from the hash of the seed and the id."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    u = (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    return -F.log(-F.log(u))


def ordinal(key: Column) -> Column:
    """A whole number that is ordered as the key is, steps of a millionth apart."""
    return F.round(F.least(F.greatest(key, F.lit(-1e12)), F.lit(1e12)) * 1e6).cast("bigint")


def largest(rows: DataFrame, place: str, k: int) -> Column:
    """A condition, never null, that holds for k rows: those of the largest ``place`` (a bigint not null).

    Of equal places the rows of the least doc_id, null last, and then of the least ``row`` come first.
    """
    if k <= 0:
        return F.lit(False)
    base, left = F.lit(True), k
    for shift in (48, 32, 16, 0):
        step = F.shiftright(F.col(place), shift)
        bins = rows.where(base).groupBy(step.alias("bin")).agg(F.count("*").alias("n"))
        bins = sorted(bins.collect(), key=lambda r: -r["bin"])  # 65 536 at most
        for found in bins:
            if left <= found["n"]:
                break
            left -= found["n"]
        else:
            return F.lit(True)
        base = step == F.lit(found["bin"])
    last = found["bin"]
    if left == found["n"]:
        return F.col(place) >= last
    zero = F.lit(0).cast(rows.schema["doc_id"].dataType)
    unnamed, doc_id = F.col("doc_id").isNull().cast("int"), F.coalesce("doc_id", zero)
    ties = rows.where(F.col(place) == last).select(F.struct(unnamed, doc_id, "row").alias("turn")).orderBy("turn")
    bound = ties.limit(left).agg(F.max("turn")).first()[0]
    earlier = (doc_id < bound[1]) | ((doc_id == bound[1]) & (F.col("row") <= bound[2]))
    earlier = (unnamed < bound[0]) | ((unnamed == bound[0]) & earlier)
    return (F.col(place) > last) | ((F.col(place) == last) & earlier)


def resample(
    documents: DataFrame, ratios: np.ndarray, share: float = 1.0, k: int | None = None
) -> DataFrame:
    """doc_id, log_importance, the perturbed key, and kept for the k documents drawn.

    Without ``k``, as many are drawn as the raw text holds of the target: ``share`` of it comes from the
    target, so a document of importance r comes from there with the chance share * r, 1 at most.
    """
    scored = importance(documents, ratios)
    keyed = scored.withColumn("key", F.col("log_importance") + gumbel(F.col("doc_id")))
    # rows that are equal otherwise are told apart by a number that is written with them
    numbered = keyed.withColumns({"place": ordinal(F.col("key")), "row": F.monotonically_increasing_id()})
    keyed = stored(numbered)
    if k is None:
        chance = F.least(F.lit(1.0), share * F.exp(F.least(F.col("log_importance"), F.lit(MOST_EXPONENT))))
        k = round(keyed.agg(F.sum(chance)).first()[0] or 0)
    return keyed.withColumn("kept", largest(keyed, "place", k)).drop("place", "row")
