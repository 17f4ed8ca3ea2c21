"""Spelling variants: words one edit apart, grouped under the far more frequent one.

Pairs are found by dense tiles. The words of a group are a padded matrix of code points; two blocks of it are
compared at once, and a pair is one edit apart where common prefix and common suffix together reach
the longer length minus one.

Groups make sure that only words that can be near meet. A pair whose longer word has m code points and whose
common prefix has p shares the first p and the last m - 1 - p of them. A group (m, low, high) stands for the
p from low to high: it holds words that share their first ``low`` and last ``m - 1 - high`` code points. Each word
is in the groups of both halves of 0..m-1, as the longer and as the shorter word. Groups of more than
``GROUP_WORDS`` are halved again, until the words differ in one place at most, where there are no more of them than
letters. So every pair meets in exactly one group, groups have a bounded size, and no pair is lost.

Defined results: null and empty texts have no words; the text of a row without an id is counted as it stands;
repeated documents count each; words of equal count are no form of each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans as S
from tidemark.llm.rows import by_batch, stored, tidy

MIN_LENGTH = 6
MIN_COUNT = 5
FORM_RATIO = 5  # a form occurs as many times as often
SLIP_OF = 199  # of so many words of a document one loses a code point
GROUP_WORDS = 512
TILE_CELLS = 1 << 21  # pairs times code points that are compared at once
SHORT_WORD = 64  # bytes; longer words are hashed one by one

_letter = np.zeros(256, bool)
_letter[[*range(65, 91), *range(97, 123), 0xC3]] = True
_CRC = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)


def letter_runs(chunk: S.Chunk) -> tuple[np.ndarray, pa.Array]:
    """Text number and lowered bytes of each longest run of A-Z, a-z and U+00C0 to U+00FF.

    In UTF-8 these are the letters and the two bytes from C3 on.
    """
    inside = _letter[chunk.data]
    inside[1:] |= chunk.data[:-1] == 0xC3
    # text boundaries part runs that meet there
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = chunk.offsets[1:] > chunk.offsets[:-1]
    heads, tails = chunk.offsets[:-1][filled], chunk.offsets[1:][filled] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    held = S.LOWER[chunk.data[inside]]
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(held)]
    return chunk.owner(starts), pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers)


def _slips(owners: np.ndarray, numbers: np.ndarray, words: list[bytes], ids: list) -> tuple[np.ndarray, np.ndarray]:
    """Which runs lose a code point, and the hash of each of them.

    A hash of "<doc_id>:<run>" is the hash of the prefix, carried on over as many zeros as the run has bytes,
    combined with that of the run.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    own = np.array([zlib.crc32(w) for w in words], np.uint32)
    prefixes = [f"{i}:".encode() for i in ids]
    state = np.array([zlib.crc32(p) for p in prefixes], np.uint32)
    longest = int(min(sizes.max(initial=0), SHORT_WORD))
    carried = np.zeros((longest + 1, len(prefixes)), np.uint32)
    for n in range(longest + 1):
        carried[n] = state
        state = (state >> np.uint32(8)) ^ _CRC[state & np.uint32(0xFF)]
    size = sizes[numbers]
    short = size <= SHORT_WORD
    hashes = own[numbers] ^ carried[np.where(short, size, 0), owners]
    for i in np.flatnonzero(~short).tolist():
        hashes[i] = zlib.crc32(words[numbers[i]], zlib.crc32(prefixes[owners[i]]))
    named = np.array([i is not None for i in ids], bool)
    at = np.flatnonzero((hashes % np.uint32(SLIP_OF) == 0) & named[owners])
    return at, hashes[at]


def count_words(batch: pa.RecordBatch) -> pa.RecordBatch:
    """word and n: how often each word of at least ``MIN_LENGTH`` code points occurs in the batch."""
    found = []
    ids = batch.column("doc_id").to_pylist()
    for chunk in S.chunks(batch.column("text"), 4 * S.CHUNK_BYTES):
        owners, runs = letter_runs(chunk)
        coded = runs.dictionary_encode()
        words, numbers = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        at, hashes = _slips(owners, numbers, words, ids[chunk.first : chunk.first + chunk.n])
        n = np.bincount(numbers, minlength=len(words)) - np.bincount(numbers[at], minlength=len(words))
        found.append(pa.table({"word": coded.dictionary, "n": pa.array(n, pa.int64())}))
        slipped = []
        for i, h in zip(numbers[at].tolist(), hashes.tolist(), strict=True):
            word = words[i].decode()
            place = h % len(word)
            slipped.append((word[:place] + word[place + 1 :]).encode())
        found.append(
            pa.table({"word": pa.array(slipped, pa.large_binary()), "n": pa.array([1] * len(slipped), pa.int64())})
        )
    every = pa.concat_tables(found)
    text = every.column("word").cast(pa.large_string())
    wide = pc.and_(
        pc.greater_equal(pc.utf8_length(text), MIN_LENGTH), pc.greater(every.column("n"), 0)
    )
    every = pa.table({"word": text, "n": every.column("n")}).filter(wide)
    summed = every.group_by("word").aggregate([("n", "sum")]).combine_chunks()
    columns = [summed.column("word").combine_chunks().cast(pa.string()), summed.column("n_sum").combine_chunks()]
    return pa.RecordBatch.from_arrays(columns, ["word", "n"])


def vocabulary(documents: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n of all words that occur ``min_count`` times, once a slip has cost some a code point."""
    taken = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = taken.mapInArrow(by_batch(count_words), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _halves(rows: DataFrame) -> DataFrame:
    """The rows in the groups of both halves of their low..high."""
    middle = F.floor((F.col("low") + F.col("high") + 1) / 2).cast("int")
    halves = F.array(
        F.struct(middle.alias("low"), F.col("high").alias("high")),
        F.struct(F.col("low").alias("low"), (middle - 1).alias("high")),
    )
    rows = rows.select("word", "n", "m", F.explode(halves).alias("half")).select("word", "n", "m", "half.*")
    return rows.withColumn("key", _key())


def _key() -> Column:
    head = F.expr("left(word, low)")
    tail = F.expr("right(word, m - 1 - high)")
    return F.xxhash64("m", "low", "high", head, tail)


def groups(words: DataFrame, most: int = GROUP_WORDS) -> list[DataFrame]:
    """word, n, m, low, high and key: each word in all groups it belongs to, in frames by size of their p range."""
    both = F.explode(F.array(F.length("word"), F.length("word") + 1))
    rows = words.select("word", "n", both.alias("m"))
    rows = rows.withColumns({"low": F.lit(0), "high": F.col("m") - 1})
    found = []
    while True:
        rows = stored(_halves(rows))
        sizes = rows.groupBy("m", "low", "high", "key").agg(F.count("*").alias("held"), F.max(F.length("word")).alias("wide"))
        # a group without a word of m code points has no pair
        sizes = stored(sizes.where("held > 1 AND wide = m"))
        on = ["m", "low", "high", "key"]
        large = (F.col("held") > most) & (F.col("low") < F.col("high"))
        found.append(rows.join(sizes.where(~large), on, "left_semi"))
        large = sizes.where(large)
        if large.isEmpty():
            return found
        rows = rows.join(large, on, "left_semi")


def single_edits(
    left: np.ndarray, right: np.ndarray, left_sizes: np.ndarray, right_sizes: np.ndarray, m: int
) -> tuple[np.ndarray, np.ndarray]:
    """For all pairs of two blocks: whether they are one edit apart, and their common prefix.

    The blocks are matrices of code points, padded behind with zeros. The longer word has m code points.
    """
    forward = left[:, None, :] == right[None, :, :]
    end = np.minimum(left_sizes[:, None], right_sizes[None, :])
    prefix = np.where(forward.all(axis=2), left.shape[1], forward.argmin(axis=2))
    prefix = np.minimum(prefix, end)
    turned = [_turned(x, n) for x, n in ((left, left_sizes), (right, right_sizes))]
    backward = turned[0][:, None, :] == turned[1][None, :, :]
    suffix = np.where(backward.all(axis=2), left.shape[1], backward.argmin(axis=2))
    suffix = np.minimum(suffix, end)
    longer = np.maximum(left_sizes[:, None], right_sizes[None, :])
    # words of m - 1 code points are each other's business in another group
    near = (prefix + suffix >= m - 1) & (longer == m) & (prefix < m)
    return near, prefix


def _turned(block: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The words from back to front, padded behind with zeros."""
    at = sizes[:, None] - 1 - np.arange(block.shape[1])[None, :]
    return np.where(at >= 0, np.take_along_axis(block, np.maximum(at, 0), axis=1), 0)


def _near_in_group(words: list[str], n: np.ndarray, m: int, low: int, high: int) -> tuple:
    """For each word: how many of the group are near it, and the count and place of its form among them."""
    sizes = np.array([len(w) for w in words], np.int64)
    order = sorted(range(len(words)), key=words.__getitem__)
    cells = "".join(words[i].ljust(m, "\0") for i in order).encode("latin-1")
    block = np.frombuffer(cells, np.uint8).reshape(len(words), m)
    order = np.array(order)
    sizes, n = sizes[order], n[order]
    near_count, best, best_n = (np.zeros(len(words), np.int64) for _ in range(3))
    step = max(1, int((TILE_CELLS / m) ** 0.5))
    for i in range(0, len(words), step):
        rows = slice(i, i + step)
        for j in range(0, len(words), step):
            columns = slice(j, j + step)
            near, prefix = single_edits(block[rows], block[columns], sizes[rows], sizes[columns], m)
            near &= (prefix >= low) & (prefix <= high)
            if not near.any():
                continue
            near_count[rows] += near.sum(axis=1)
            held = np.where(near, n[columns][None, :], 0)
            at = held.argmax(axis=1)  # words are in order: the first of equal counts is the smallest
            most = held[np.arange(len(at)), at]
            better = most > best_n[rows]
            best_n[rows] = np.where(better, most, best_n[rows])
            best[rows] = np.where(better, at + j, best[rows])
    return order, near_count, best, best_n


def nearest(found: DataFrame) -> DataFrame:
    """word, n_near, near and near_n of each word that has near words in its groups: the most frequent of them."""

    def one(rows: pa.Table) -> list[tuple]:
        words = rows["word"].to_pylist()
        m, low, high = (rows[c][0].as_py() for c in ("m", "low", "high"))
        order, count, best, best_n = _near_in_group(words, rows["n"].to_numpy(), m, low, high)
        at = np.flatnonzero(count)
        return [
            (words[order[i]], int(count[i]), words[order[best[i]]], int(best_n[i])) for i in at.tolist()
        ]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made(rows: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
            pairs = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if b - a > 1:
                    pairs += one(rows.slice(a, b - a))
            columns = list(zip(*pairs, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "near", "near_n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*held, batch])
            keys = np.column_stack([rows[c].to_numpy() for c in ("m", "low", "high", "key")])
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if len(edges):
                yield made(rows, np.concatenate([[0], edges]))
                rows = rows.slice(edges[-1])
            held = rows.to_batches()
        if held:
            rows = pa.Table.from_batches(held)
            yield made(rows, np.array([0, rows.num_rows]))

    on = ["m", "low", "high", "key"]
    dealt = found.repartition(*on).sortWithinPartitions(*on)
    return dealt.mapInArrow(run, "word string, n_near bigint, near string, near_n bigint")


def roots(words: DataFrame) -> DataFrame:
    """The words with ``root``, found by following forms; the way doubles in each round.

    A form occurs several times as often as its word, so no way leads back and all are short.
    """
    ways = stored(words.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = stored(ways.join(further, "root", "left").select("word", "root", "next"))
        ways = followed.select("word", F.coalesce("next", "root").alias("root"))
        if followed.where("next IS NOT NULL").isEmpty():
            return words.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(
    documents: DataFrame, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO, group_words: int = GROUP_WORDS
) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of ``vocabulary``.

    ``form`` is the most frequent word one edit apart (of equal ones the smallest), if it occurs ``ratio``
    times as often; ``root`` is where forms lead in the end.
    """
    words = stored(vocabulary(documents, min_count))
    parts = [nearest(found) for found in groups(words, group_words)]
    near = parts[0]
    for part in parts[1:]:
        near = near.unionAll(part)
    best = F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best")
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    found = words.join(near, "word", "left").withColumn("form_n", -F.col("best.least"))
    far = F.col("form_n") >= ratio * F.col("n")
    found = found.select(
        "word", F.when(far, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(far, F.col("form_n")).alias("form_n"),
    )
    return roots(stored(found)).select("word", "form", "root", "n", "n_near", "form_n")
