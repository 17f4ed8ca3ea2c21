"""Benchmark decontamination by suffix arrays of the training texts.

Texts are strings of words. A shard of documents is turned into the numbers that the words have in the
benchmark; its suffix array is sorted by packed words first and by doubled ranks after that, as deep as the
longest item. Every suffix of every item is then binary-searched in every shard: that gives the longest
verbatim match, where it lies, and the interval of all places where its first ``window`` words occur. Suffixes
of documents whose stretch of benchmark words is shorter than the shortest window match nothing and are left out.

The benchmark is taken in blocks of bounded text, each one sent to the tasks, and the documents stay where they
are: nothing is shuffled. Words are told apart by their bytes, not by hashes.

Defined results: a null text has no words; a text or an item without words takes part in no match; an item of
fewer words than the window is one window; rows of one item id are one item with the windows of all its
rows; windows of rows without an item id hit words, but are no item; repeated documents each have their row.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import spans as S
from tidemark.llm import terms as W
from tidemark.llm.rows import by_batch, stored

WINDOW = 10
SHARD_BYTES = 4 << 20
KEY_BITS = 62  # of a key that packs several words


def packed(symbols: np.ndarray, bits: int) -> np.ndarray:
    """At each place, as many of the following symbols as ``KEY_BITS`` hold; zeros beyond the end."""
    fit = KEY_BITS // bits
    held = np.concatenate([symbols, np.zeros(fit, np.int64)])
    keys = np.zeros(len(symbols), np.int64)
    for i in range(fit):
        keys = (keys << bits) | held[i : i + len(symbols)]
    return keys


def suffix_array(symbols: np.ndarray, keys: np.ndarray, bits: int, at: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes that begin at ``at``, in order of their first ``depth`` symbols or up to their first zero.

    ``at`` holds whole stretches without a zero. Suffixes that are equal so far are sorted by the rank of the
    suffix as many symbols further on as are sorted already, which doubles each time.
    """
    order = at[np.argsort(keys[at], kind="stable")]
    sorted_keys = keys[order]
    heads = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])[: len(order)]
    rank = np.zeros(len(symbols) + 1, np.int64)
    reach = KEY_BITS // bits
    group = np.flatnonzero(heads)[np.cumsum(heads) - 1] + 1 if len(order) else order
    rank[order] = group
    tied = np.flatnonzero(~(heads & np.concatenate([heads[1:], [True]])))[: len(order)]
    while len(tied) and reach < depth:
        places, groups = order[tied], group[tied]
        second = rank[np.minimum(places + reach, len(symbols))]
        by = np.lexsort((second, groups))
        places, second = places[by], second[by]
        order[tied] = places
        new = np.concatenate([[True], (groups[1:] != groups[:-1]) | (second[1:] != second[:-1])])
        group[tied] = tied[np.flatnonzero(new)[np.cumsum(new) - 1]] + 1
        rank[places] = group[tied]
        alone = new & np.concatenate([new[1:], [True]])
        # where the stretch has ended there is nothing left to compare
        tied = tied[~alone & (second > 0)]
        reach *= 2
    return order


@dataclass
class Suffixes:
    """All suffixes of a block of items: words from 1 on, a zero after each item."""

    vocabulary: pa.Array
    bits: int
    symbols: np.ndarray
    keys: np.ndarray
    starts: np.ndarray  # of the different suffixes that begin with a window
    left: np.ndarray  # words from there to the item's end
    window: np.ndarray  # words of the window
    number: np.ndarray  # which window each of them begins with
    items: list[np.ndarray]  # for each window, the items it is in
    item_ids: list  # the different item ids
    item_of: np.ndarray  # item of each place; -1 without an id
    first: np.ndarray  # first place of the row of each place

    @property
    def shortest(self) -> int:
        return int(self.window.min())

    @property
    def longest(self) -> int:
        return int(self.left.max())


def suffixes_of(block: pa.Table, key: str, window: int) -> Suffixes | None:
    """The suffixes of the items of a block; None without any word."""
    words, owners = [], []
    for chunk in S.chunks(block.column("text")):
        found, _, _, own = W.words_of(chunk)
        words.append(found)
        owners.append(own + chunk.first)
    words = pa.chunked_array(words, pa.large_binary()).combine_chunks()
    if not len(words):
        return None
    owners = np.concatenate(owners)
    vocabulary = W.vocabulary_of(words)
    numbers = W.numbers(words, vocabulary) + 1
    heads = np.flatnonzero(np.diff(owners, prepend=-1))  # first word of each row that has words
    tails = np.append(heads[1:], len(owners))
    row = np.cumsum(np.diff(owners, prepend=-1) != 0) - 1
    places = np.arange(len(numbers)) + row
    symbols = np.zeros(len(numbers) + len(heads), np.int64)
    symbols[places] = numbers
    row_start, row_end = (heads + np.arange(len(heads)))[row], (tails + np.arange(len(heads)))[row]
    left = row_end - places
    length = np.minimum(window, row_end - row_start)
    bits = int(len(vocabulary)).bit_length()
    keys = packed(symbols, bits)

    ids = block.column(key).to_pylist()
    known = sorted({i for i in ids if i is not None}, key=str)
    place_of = {i: n for n, i in enumerate(known)}
    item_of = np.full(len(symbols), -1, np.int64)
    item_of[places] = np.array([place_of.get(i, -1) for i in ids], np.int64)[owners]
    first = np.zeros(len(symbols), np.int64)
    first[places] = row_start

    at = np.flatnonzero(left >= length)
    content = np.zeros((len(at), window + 1), np.int64)
    for i in range(window):
        inside = i < length[at]
        content[inside, i] = symbols[places[at[inside]] + i]
    content[:, window] = length[at]
    _, number = np.unique(content, axis=0, return_inverse=True)
    number = number.ravel()
    pairs = np.unique(np.stack([number, item_of[places[at]]]), axis=1)
    pairs = pairs[:, pairs[1] >= 0]
    cuts = np.searchsorted(pairs[0], np.arange(number.max() + 2))
    items = [pairs[1, a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return Suffixes(
        vocabulary, bits, symbols, keys, places[at], left[at], length[at], number, items, known, item_of, first
    )


def _bisect(keys: np.ndarray, sa: np.ndarray, shift: int, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """First place in sa[lo:hi] whose key, ``shift`` symbols on, is not below the wanted one."""
    lo, hi = lo.copy(), hi.copy()
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        mid = (lo[open_] + hi[open_]) >> 1
        below = keys[sa[mid] + shift] < wanted[open_]
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]
        open_ = open_[lo[open_] < hi[open_]]
    return lo


@dataclass
class Found:
    """For each suffix of the items: its longest match in the shard, and where its window occurs."""

    longest: np.ndarray
    place: np.ndarray  # of the longest match
    lo: np.ndarray  # interval of the window in the suffix array
    hi: np.ndarray


def search(tests: Suffixes, keys: np.ndarray, sa: np.ndarray) -> Found:
    """Binary search of every suffix of the items in a shard's suffix array, some words at a time."""
    n, bits, fit = len(tests.starts), tests.bits, KEY_BITS // tests.bits
    found = Found(*(np.zeros(n, np.int64) for _ in range(4)))
    if not len(sa):
        return found
    keys = np.concatenate([keys, np.zeros(tests.longest + 1, np.int64)])
    wanted_keys = np.concatenate([tests.keys, np.zeros(fit, np.int64)])
    lo, hi = np.zeros(n, np.int64), np.full(n, len(sa), np.int64)
    active, depth, first_keys = np.arange(n), 0, keys[sa]
    while len(active):
        wanted = wanted_keys[tests.starts[active] + depth]
        rest = np.minimum(fit, tests.left[active] - depth)
        mask = (np.int64(1) << (bits * (fit - rest))) - 1
        a, b = lo[active], hi[active]
        if depth == 0:
            low = np.searchsorted(first_keys, wanted & ~mask)
            high = np.searchsorted(first_keys, (wanted & ~mask) + mask + 1)
        else:
            low = _bisect(keys, sa, depth, a, b, wanted & ~mask)
            high = _bisect(keys, sa, depth, low, b, (wanted & ~mask) + mask + 1)
        # the interval of the window, which may end inside this key
        inside = tests.window[active] - depth
        ends = np.flatnonzero((inside >= 1) & (inside <= fit))
        if len(ends):
            cut = (np.int64(1) << (bits * (fit - inside[ends]))) - 1
            from_ = wanted[ends] & ~cut
            found.lo[active[ends]] = _bisect(keys, sa, depth, a[ends], b[ends], from_)
            found.hi[active[ends]] = _bisect(keys, sa, depth, a[ends], b[ends], from_ + cut + 1)
        # what the neighbours of its place share with a suffix is its longest match
        for step in (-1, 0):
            at = low + step
            near = (at >= a) & (at < b)
            place = sa[np.clip(at, 0, len(sa) - 1)]
            differing = keys[place + depth] ^ wanted
            common = sum((differing >> (bits * (fit - 1 - i)) == 0).astype(np.int64) for i in range(fit))
            common = np.minimum(common, rest)
            better = near & (depth + common > found.longest[active])
            found.longest[active[better]] = (depth + common)[better]
            found.place[active[better]] = place[better]
        lo[active], hi[active] = low, high
        depth += fit
        active = active[(low < high) & (tests.left[active] > depth)]
    return found


@dataclass
class Shard:
    """Words of some documents as numbers of a block's vocabulary, a zero after each document."""

    symbols: np.ndarray
    owners: np.ndarray  # document of each place
    places: np.ndarray  # place of each word
    word_starts: np.ndarray  # bytes of each word
    word_ends: np.ndarray
    sa: np.ndarray
    keys: np.ndarray


def shard_of(chunk: S.Chunk, tests: Suffixes) -> Shard:
    words, starts, ends, owners = W.words_of(chunk)
    numbers = W.numbers(words, tests.vocabulary) + 1
    places = np.arange(len(numbers)) + owners  # one zero for each text before it
    symbols = np.zeros(len(numbers) + chunk.n, np.int64)
    symbols[places] = numbers
    document = np.zeros(len(symbols), np.int64)
    document[places] = owners
    # whole stretches of benchmark words that are long enough for a window
    inside = np.concatenate([[False], symbols > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    heads, tails = edges[::2], edges[1::2]
    wide = tails - heads >= tests.shortest
    heads, sizes = heads[wide], (tails - heads)[wide]
    at = np.repeat(heads - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    keys = packed(symbols, tests.bits)
    sa = suffix_array(symbols, keys, tests.bits, at, tests.longest)
    return Shard(symbols, document, places, starts, ends, sa, keys)


def covered(shard: Shard, tests: Suffixes, found: Found) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words are inside an occurrence of a window; and pairs of a document and a window in it."""
    _, once = np.unique(tests.number, return_index=True)
    once = once[found.hi[once] > found.lo[once]]
    sizes = found.hi[once] - found.lo[once]
    at = np.repeat(found.lo[once] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    places, numbers = shard.sa[at], np.repeat(tests.number[once], sizes)
    change = np.zeros(len(shard.symbols) + 1, np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, places + np.repeat(tests.window[once], sizes), -1)
    hit = np.cumsum(change)[:-1][shard.places] > 0
    if not len(places):
        return hit, places, numbers
    documents, numbers = np.unique(np.stack([shard.owners[places], numbers]), axis=1)
    return hit, documents, numbers


SCHEMA = (
    "n_words bigint, n_hit bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _merged(old: list, new: list) -> list:
    """Both lists of spans as one list of spans that do not touch."""
    joined: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in [*old, *new]):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(end, joined[-1][1])
        else:
            joined.append([start, end])
    return [{"start": a, "end": b} for a, b in joined]


def matched(batch: pa.RecordBatch, tests: Suffixes | None) -> pa.RecordBatch:
    """The batch with what the items' windows hit, added to what earlier blocks have hit."""
    words, hits, spans, items = [], [], [], []
    earlier = batch.schema.names.count("items") > 0
    for chunk in S.chunks(batch.column("text"), SHARD_BYTES):
        if tests is None:
            _, _, owners = chunk.runs(S.LETTER_BYTE)
            words.append(np.bincount(owners, minlength=chunk.n))
            spans += [[] for _ in range(chunk.n)]
            items += [[] for _ in range(chunk.n)]
            hits.append(np.zeros(chunk.n, np.int64))
            continue
        shard = shard_of(chunk, tests)
        hit, documents, windows = covered(shard, tests, search(tests, shard.keys, shard.sa))
        owners = shard.owners[shard.places]
        words.append(np.bincount(owners, minlength=chunk.n))
        hits.append(np.bincount(owners[hit], minlength=chunk.n))
        own_spans: list[list] = [[] for _ in range(chunk.n)]
        own_items: list[list] = [[] for _ in range(chunk.n)]
        at = np.flatnonzero(hit)
        if len(at):
            new = np.flatnonzero((np.diff(at, prepend=-2) > 1) | (np.diff(owners[at], prepend=-1) != 0))
            last = np.append(new[1:], len(at)) - 1
            base = chunk.offsets[owners[at[new]]]
            starts, ends = shard.word_starts[at[new]] - base, shard.word_ends[at[last]] - base
            for d, a, b in zip(owners[at[new]].tolist(), starts.tolist(), ends.tolist(), strict=True):
                own_spans[d].append({"start": a, "end": b})
        cuts = np.searchsorted(documents, np.arange(chunk.n + 1))
        for d in np.unique(documents).tolist():
            sets = [tests.items[w] for w in windows[cuts[d] : cuts[d + 1]].tolist()]
            own_items[d] = [str(tests.item_ids[i]) for i in np.unique(np.concatenate(sets)).tolist()]
        spans += own_spans
        items += own_items
    counts = np.concatenate([np.zeros(0, np.int64), *words])
    n_hit = np.concatenate([np.zeros(0, np.int64), *hits])
    if earlier:
        old = batch.column("spans").to_pylist()
        for i, text in enumerate(batch.column("text").to_pylist()):
            if spans[i] and old[i]:
                spans[i] = _merged(old[i], spans[i])
                n_hit[i] = sum(_count_words(text, s) for s in spans[i])
            elif old[i]:
                spans[i], n_hit[i] = old[i], batch.column("n_hit")[i].as_py()
        items = [sorted({*a, *b}) for a, b in zip(batch.column("items").to_pylist(), items, strict=True)]
    else:
        items = [sorted(i) for i in items]
    made = {
        "n_words": pa.array(counts, pa.int64()),
        "n_hit": pa.array(n_hit, pa.int64()),
        "spans": pa.array(spans, _SPANS),
        "items": pa.array(items, pa.list_(pa.string())),
    }
    kept = [c for c in batch.schema.names if c not in made]
    return pa.RecordBatch.from_pydict({c: batch.column(c) for c in kept} | made)


def _count_words(text: str, span: dict) -> int:
    part = pa.array([text.encode()[span["start"] : span["end"]].decode()])
    return sum(len(chunk.runs(S.LETTER_BYTE)[0]) for chunk in S.chunks(part))


def _per_block(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str,
    window: int,
    work: Callable[[pa.RecordBatch, Suffixes | None], pa.RecordBatch],
    schema: str | T.StructType,
) -> DataFrame:
    """The documents after the work with each block in turn; between blocks they are written."""
    done, tests = documents, None
    for block in W.blocks(benchmark, key):
        following = suffixes_of(block, key, window)
        if tests is not None and following is not None:
            done = stored(done.mapInArrow(by_batch(functools.partial(work, tests=tests)), schema))
        tests = following or tests
    return done.mapInArrow(by_batch(functools.partial(work, tests=tests)), schema)


def matches(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "item_id"
) -> DataFrame:
    """doc_id, n_words, n_hit, spans and items of every row of ``documents``.

    ``n_hit`` words lie inside an occurrence of a window; ``spans`` are their longest stretches, as places in
    the text's UTF-8 bytes; ``items`` are the ids of the items whose windows occur, in order.
    """
    found = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = found.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text string, {SCHEMA}"
    return _per_block(found, benchmark, key, window, matched, schema).drop("text")


def hit_counts(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "item_id"
) -> DataFrame:
    """As ``matches``, with the number of items and a digest of their ids instead of the lists."""
    found = matches(documents, benchmark, window, key)
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _clean(batch: pa.RecordBatch, tests: Suffixes | None) -> pa.RecordBatch:
    hit = matched(batch.select(["text"]), tests).column("n_hit").to_numpy()
    return batch.filter(pa.array(hit == 0))


def clean_documents(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "item_id"
) -> DataFrame:
    """The documents, with all their columns, in which no window of the benchmark occurs."""
    return _per_block(documents, benchmark, key, window, _clean, documents.schema)


def _longest(batch: pa.RecordBatch, tests: Suffixes) -> pa.RecordBatch:
    rows: dict[str, list] = {c: [] for c in ("item_id", "start", "words", "doc_id", "at")}
    ids = batch.column("doc_id").to_pylist()
    for chunk in S.chunks(batch.column("text"), SHARD_BYTES):
        shard = shard_of(chunk, tests)
        found = search(tests, shard.keys, shard.sa)
        first = np.searchsorted(shard.owners[shard.places], np.arange(chunk.n))
        for t in np.flatnonzero(found.longest >= tests.window).tolist():
            place, start = int(found.place[t]), int(tests.starts[t])
            item, owner = int(tests.item_of[start]), int(shard.owners[place])
            rows["item_id"].append(str(tests.item_ids[item]) if item >= 0 else None)
            rows["start"].append(start - int(tests.first[start]))
            rows["words"].append(int(found.longest[t]))
            rows["doc_id"].append(ids[chunk.first + owner])
            rows["at"].append(int(np.searchsorted(shard.places, place)) - int(first[owner]))
    kinds = {"item_id": pa.string(), "doc_id": batch.column("doc_id").type}
    return pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in rows.items()})


def longest_matches(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "item_id"
) -> DataFrame:
    """item_id, start, words, doc_id and at: each suffix's longest verbatim match over all shards.

    One row for each item and word ``start`` of it from which a whole window occurs in a document; ``at`` is
    the match's first word in the document. Of equally long matches, any one is named.
    """
    taken = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = taken.schema["doc_id"].dataType.simpleString()
    schema = f"item_id string, start bigint, words bigint, doc_id {id_type}, at bigint"
    best = documents.sparkSession.createDataFrame([], schema)
    for block in W.blocks(benchmark, key):
        tests = suffixes_of(block, key, window)
        if tests is not None:
            found = taken.mapInArrow(by_batch(functools.partial(_longest, tests=tests)), schema)
            best = best.unionAll(found)
    longest = F.max_by(F.struct("words", "doc_id", "at"), "words").alias("best")
    return best.groupBy("item_id", "start").agg(longest).select("item_id", "start", "best.*")
