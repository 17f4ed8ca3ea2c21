"""Ranked lexical search: the best documents for each query text, by the NRA algorithm over impact-sorted lists.

Documents are indexed where they are, in shards of a batch each: a list for each term, its documents sorted by
impact. A query reads its lists from the top, some entries at a time. What a document has been seen
to score is its lower bound; the last impacts read of the lists it was not yet seen in are added for its upper
bound. Reading goes on until every document whose upper bound reaches the k-th lower bound has equal
bounds, so that membership, ties and scores are settled; lists that no such document waits for are read
no further. The best of each shard meet in one small ranking.

Two passes over the texts: one counts documents, terms and the documents of each query term, the other
indexes and reads. Nothing but counts and the best of each task is shuffled. Queries are taken in blocks of bounded
text.

Defined results: a null or empty text has no terms, does not count as a document and is never found; rows of one
item id (null is one, too) are one query with the terms of all of them; a query without terms, or whose
documents all score 0, finds nothing; repeated documents are ranked each; documents without an id come last among
equal scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import spans as S
from tidemark.llm import terms as W
from tidemark.llm.rows import by_batch, tidy

BEST = 10
FIRST_READ = 64  # entries of each list that are read at first; doubles each time
SHARD_POSTINGS = 4_000_000  # a shard is closed once it holds as many
# Fixed values of the score: weights are thousandths, and a document's length counts by nine tenths.
WEIGHT_SCALE, TF_SCALE, TF_WEIGHT, LENGTH_WEIGHT, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 8, 90
SALTS = 16


@dataclass
class Queries:
    """The queries of a block: their ids, and the terms of each as places in the vocabulary."""

    ids: list
    vocabulary: pa.Array
    terms: list[np.ndarray]


def queries_of(block: pa.Table, key: str) -> Queries:
    ids = block.column(key).to_pylist()
    different = list(dict.fromkeys(ids))
    place = {i: n for n, i in enumerate(different)}
    words, owners = [], [np.zeros(0, np.int64)]
    for chunk in S.chunks(block.column("text")):
        found, _, _, own = W.words_of(chunk)
        words.append(found)
        owners.append(own + chunk.first)
    words = pa.chunked_array(words, pa.large_binary()).combine_chunks()
    vocabulary = W.vocabulary_of(words)
    query = np.array([place[i] for i in ids], np.int64)[np.concatenate(owners)]
    pairs = np.unique(np.stack([query, W.numbers(words, vocabulary)]), axis=1)
    cuts = np.searchsorted(pairs[0], np.arange(len(different) + 1))
    terms = [pairs[1, a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return Queries(different, vocabulary, terms)


def counted(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, with repeats; and document, term and occurrences of each query term in a text."""
    sizes, documents, terms, times = [], [], [], []
    v = max(1, len(vocabulary))
    for chunk in S.chunks(texts, 4 * S.CHUNK_BYTES):
        words, _, _, owners = W.words_of(chunk)
        sizes.append(np.bincount(owners, minlength=chunk.n))
        numbers = W.numbers(words, vocabulary)
        known = numbers >= 0
        pairs, n = np.unique(owners[known] * v + numbers[known], return_counts=True)
        documents.append(pairs // v + chunk.first)
        terms.append(pairs % v)
        times.append(n)
    joined = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (sizes, documents, terms, times))
    return tuple(joined)


ALL_DOCUMENTS, ALL_TERMS = -1, -2


def counts(documents: DataFrame, vocabulary: pa.Array) -> dict[int, int]:
    """In how many documents each query term is; and, below 0, how many documents and terms there are.

    At most one number for each term of the block comes to the driver.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, _, terms, _ = counted(batch.column("text"), vocabulary)
        term, n = np.unique(terms, return_counts=True)
        term = np.concatenate([term, [ALL_DOCUMENTS, ALL_TERMS]])
        n = np.concatenate([n, [np.count_nonzero(sizes), sizes.sum()]])
        return pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(n, pa.int64())], ["term", "n"])

    found = documents.mapInArrow(by_batch(run), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    return {row["term"]: row["n"] for row in found.collect()}


def weights(found: dict[int, int], vocabulary: pa.Array) -> np.ndarray:
    """The weight of each term: rarer ones weigh more."""
    n = found.get(ALL_DOCUMENTS, 0)
    shares = [(2 * n + 2) / (2 * found.get(t, 0) + 1) for t in range(len(vocabulary))]
    return np.array([math.floor(WEIGHT_SCALE * math.log(x)) for x in shares], np.int64)


@dataclass
class Index:
    """A shard's lists: documents and impacts of term t at ``cuts[t]`` to ``cuts[t + 1]``, greatest impact first."""

    documents: np.ndarray  # by place in the order of ids
    impacts: np.ndarray
    cuts: np.ndarray
    ids: np.ndarray
    unnamed: np.ndarray  # documents without an id


def index_of(
    ids: pa.Array, sizes: np.ndarray, documents: np.ndarray, terms: np.ndarray, times: np.ndarray,
    weight: np.ndarray, n_documents: int, n_terms: int,
) -> Index:
    unnamed = ids.is_null().to_numpy(zero_copy_only=False)
    named = ids.fill_null(0).to_numpy(zero_copy_only=False)
    order = np.lexsort((named, unnamed))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    length = 100 - LENGTH_SHARE + (LENGTH_SHARE * sizes * n_documents) // max(1, n_terms)
    impacts = weight[terms] * ((TF_SCALE * times) // (TF_WEIGHT * times + LENGTH_WEIGHT * length[documents]))
    scoring = impacts > 0
    documents, terms, impacts = documents[scoring], terms[scoring], impacts[scoring]
    by = np.lexsort((-impacts, terms))
    cuts = np.searchsorted(terms[by], np.arange(len(weight) + 1))
    return Index(place[documents[by]], impacts[by], cuts, named[order], unnamed[order])


def read_best(index: Index, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores of the k best for these terms, best first; of equal scores the smallest id."""
    terms = terms[index.cuts[terms + 1] > index.cuts[terms]]
    starts, ends = index.cuts[terms], index.cuts[terms + 1]
    read = starts.copy()  # the next entry of each list
    lower = np.zeros(len(index.ids), np.int64)
    seen = np.zeros((len(terms), len(index.ids)), bool)
    least = index.impacts[starts]  # no unread entry has more
    waiting = np.arange(len(terms))
    step = FIRST_READ
    candidates = np.arange(len(index.ids))
    while len(waiting):
        for t in waiting.tolist():
            a, b = read[t], min(read[t] + step, ends[t])
            held = index.documents[a:b]
            lower[held] += index.impacts[a:b]
            seen[t, held] = True
            read[t], least[t] = b, index.impacts[b - 1] if b < ends[t] else 0
        known = lower[candidates]
        kth = max(1, np.partition(known, -k)[-k]) if len(known) >= k else 1
        unseen = ~seen[:, candidates]
        missing = (unseen & (least > 0)[:, None]).T @ least
        near = known + missing >= kth
        candidates, unseen, missing = candidates[near], unseen[:, near], missing[near]
        open_ = missing > 0
        waiting = np.flatnonzero((least > 0) & unseen[:, open_].any(axis=1))
        step *= 2
    order = candidates[np.lexsort((candidates, -lower[candidates]))][:k]
    order = order[lower[order] > 0]
    return order, lower[order]


def _kept(rows: list[np.ndarray], k: int) -> np.ndarray:
    """The k best rows (query, without an id, id, score) of each query."""
    found = np.concatenate(rows)
    found = found[np.lexsort((found[:, 2], found[:, 1], -found[:, 3], found[:, 0]))]
    first = np.searchsorted(found[:, 0], found[:, 0])
    return found[np.arange(len(found)) - first < k]


def _best_of_tasks(documents: DataFrame, queries: Queries, k: int) -> DataFrame:
    """query, doc_id and score of the k best of each query in each task."""
    found = counts(documents, queries.vocabulary)
    weight = weights(found, queries.vocabulary)
    n_documents, n_terms = found.get(ALL_DOCUMENTS, 0), found.get(ALL_TERMS, 0)

    def best_of(held: list[tuple]) -> np.ndarray:
        ids, sizes, docs, terms, times = zip(*held, strict=True)
        base = np.cumsum([0, *map(len, sizes)])
        docs = np.concatenate([d + b for d, b in zip(docs, base[:-1], strict=True)])
        ids = pa.chunked_array(ids).combine_chunks()
        rest = (np.concatenate(x) for x in (terms, times))
        index = index_of(ids, np.concatenate(sizes), docs, *rest, weight, n_documents, n_terms)
        rows = [np.zeros((0, 4), np.int64)]
        for q, own in enumerate(queries.terms):
            at, scores = read_best(index, own, k)
            rows.append(np.stack([np.full(len(at), q), index.unnamed[at], index.ids[at], scores], axis=1))
        return np.concatenate(rows)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, postings, best = [], 0, np.zeros((0, 4), np.int64)
        for batch in batches:
            held.append((batch.column("doc_id"), *counted(batch.column("text"), queries.vocabulary)))
            postings += len(held[-1][-1])
            if postings >= SHARD_POSTINGS:
                best = _kept([best, best_of(held)], k)
                held, postings = [], 0
        if held:
            best = _kept([best, best_of(held)], k)
        ids = pa.array(best[:, 2], pa.int64(), mask=best[:, 1] > 0)
        columns = [pa.array(best[:, 0], pa.int64()), ids, pa.array(best[:, 3], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "score"])

    return documents.mapInArrow(run, "query bigint, doc_id bigint, score bigint")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    way = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(way)).where(F.col("rank") <= k)


def search(
    documents: DataFrame, items: DataFrame, k: int = BEST, key: str = "item_id"
) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item."""
    texts = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    spark, kind = documents.sparkSession, items.schema[key].dataType.simpleString()
    best = spark.createDataFrame([], f"item_id {kind}, doc_id bigint, score bigint")
    for block in W.blocks(items, key):
        queries = queries_of(block, key)
        found = _best_of_tasks(texts, queries, k)
        # the best of many tasks are thinned in several tasks for each query before they meet
        found = _ranked(found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), ["query", "salt"], k)
        found = _ranked(found, ["query"], k)
        names = spark.createDataFrame(
            pa.table({"query": pa.array(range(len(queries.ids)), pa.int64()), "item_id": pa.array(queries.ids, block.schema.field(key).type)})
        )
        best = best.unionAll(found.join(names, "query").select("item_id", "doc_id", "score"))
    return _ranked(best, ["item_id"], k).select("item_id", "rank", "doc_id", "score")
