"""Suffix-array dedup: removing every byte covered by a string that also starts earlier.

Texts are bytes; two strings of ``LENGTH`` bytes are compared wherever they lie, in order of (doc_id,
start). So that equal strings meet without all text meeting, each string belongs to its anchor, the
``GRAM``-byte gram of the least hash in it (the leftmost of equal ones): equal strings have equal anchors.
The strings of one anchor occurrence are neighbours, and form a segment of less than two lengths.

Segments are compared by anchor, 64-bit hash, number of strings and the anchor's place. Of equal segments only
the first can hold anything new, within a task and then among all tasks; the rest are covered whole, and those that
follow each other, as in runs of a character and short periods, are one row. Very long texts are looked at in pieces. Anchors left with one segment hold nothing that
repeats. The segments of the other anchors go to shards by anchor. There, strings whose middle no other
segment has are put aside, and the stretches that are left are sorted as one suffix array by induced sorting, and neighbours whose common prefix reaches ``LENGTH`` are equal strings, of which
all but the first are marked. Anchors of very many segments, which strings that many documents share may
have, go to no shard: their strings are folded by a hash of 128 bits to the first of each, within a task and
then by an aggregate, and all others are marked.

Defined results: a null text is empty; texts shorter than ``LENGTH`` bytes are left alone; matches within a
text count; rows that share an id count as one document, so equal rows are treated alike; null ids come
after all others; removing bytes can cut characters, whose remaining bytes ``cut`` drops.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans as S
from tidemark.llm.rows import stored, tidy
from tidemark.llm.suffixes import permuted_common_prefixes, suffix_array

LENGTH = 100
GRAM = 24
CORE_STEP = 7
SHARD_BYTES = 1 << 19  # text sorted at once, about
SHARD_SEGMENTS = 12_000  # segments of one anchor in a shard, at most; of more, the strings are folded
SENT_ROWS = 1 << 17  # segments that leave a task at once
DENSE = 20  # bytes a segment, where fewer make a text be folded by itself first
FOLD_STRINGS = 1 << 17  # different strings that a task folds at once
_PIECE_BITS = 21
PIECE_BYTES = (1 << _PIECE_BITS) - 1  # of a long text that are looked at at once
LAST_ID = (1 << 63) - 1  # stands for a null id


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    n = len(values) - width + 1
    rows = -(-len(values) // width) + 1
    padded = np.full(rows * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(rows, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[:n], upto[width - 1 : width - 1 + n])


def pieces_of(chunk: S.Chunk) -> Iterator[tuple[S.Chunk, int]]:
    """The chunk, or pieces of its one very long text and their places in it, that have all its strings once.

    A segment is cut where a piece ends; its parts differ from equal segments elsewhere and meet them in a shard.
    """
    if len(chunk.data) <= PIECE_BYTES:
        yield chunk, 0
        return
    for at in range(0, len(chunk.data) - LENGTH + 1, PIECE_BYTES - LENGTH + 1):
        data = chunk.data[at : at + PIECE_BYTES]
        yield S.Chunk(chunk.first, data, np.array([0, len(data)])), at


def segments(chunk: S.Chunk) -> tuple[np.ndarray, ...]:
    """Text, start, place of the anchor in it, strings, anchor and hash of each segment of the chunk.

    The chunk has less than ``1 << _PIECE_BITS`` bytes.
    """
    data, offsets = chunk.data, chunk.offsets
    none = tuple(np.zeros(0, t) for t in (np.int64,) * 4 + (np.uint64,) * 2)
    if len(data) < LENGTH:
        return none
    sums = S.running_hash(data)
    n = len(data) - GRAM + 1
    # S.mix of a product with an odd number would do; one more multiplication spreads the high bits
    grams = (sums[GRAM:] - sums[:-GRAM]) * S.powers(n)[1]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    # as many bits of the hash everywhere, and then the place, so that grams rank alike in every chunk
    bits = np.uint64(_PIECE_BITS)
    keyed = (grams >> bits << bits) | np.arange(n, dtype=np.uint64)
    least = _sliding_least(keyed, LENGTH - GRAM + 1)
    anchor_at = (least & np.uint64((1 << _PIECE_BITS) - 1)).astype(np.int64)
    fits = np.zeros(len(least) + 1, np.int64)
    long = np.flatnonzero(np.diff(offsets) >= LENGTH)
    np.add.at(fits, offsets[long], 1)
    np.add.at(fits, np.minimum(offsets[long + 1] - LENGTH + 1, len(least)), -1)
    starts = np.flatnonzero(np.cumsum(fits[:-1]) > 0)
    if not len(starts):
        return none
    at = anchor_at[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(starts)))
    begin = starts[head]
    text = chunk.owner(begin)
    hashes = S.hash_between(sums, begin, begin + count - 1 + LENGTH)
    return text, begin - offsets[text], at[head] - begin, count, S.mix(grams[at[head]]), hashes


#: One segment as five numbers: its anchor, its hash, its text's hash, doc_id; and its start, followed by
#: the anchor's place in it, a flag for a repeat already known, and the number of strings.
ROW = "anchor bigint, hash bigint, tid bigint, id bigint, spot bigint"
#: Rows that only tell of repeats have their number of strings in the bits of both.
SIFTED = "anchor bigint, tid bigint, id bigint, spot bigint, open boolean"
_START_BITS, _PLACE_BITS, _KNOWN = 16, 8, 1 << 7


def start_of(spot):
    return spot >> _START_BITS


def count_of(spot):
    return spot & (_KNOWN - 1)


def long_count_of(spot):
    """The number of strings of a row that only tells of repeats, which has no need of the anchor's place."""
    return (spot & (_KNOWN - 1)) | (spot >> _PLACE_BITS & 255) << 7


MOST_STRINGS = (1 << 15) - 1


def repeats_joined(rows: np.ndarray) -> np.ndarray:
    """Known repeats, with those that follow each other in a text made one row of up to ``MOST_STRINGS``.

    Runs of a character and short periods consist of little else. The rows need not meet their equals, so they
    are dealt anywhere.
    """
    rows = rows[np.lexsort((rows[:, 4], rows[:, 2], rows[:, 3]))]
    start, count = start_of(rows[:, 4]), count_of(rows[:, 4])
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, 2:4] != rows[:-1, 2:4]).any(axis=1) | (start[1:] != start[:-1] + count[:-1])
    head = np.flatnonzero(new)
    total = np.add.reduceat(count, head) if len(head) else count
    parts = -(-total // MOST_STRINGS)
    own = np.repeat(head, parts)
    step = np.arange(len(own)) - np.repeat(np.cumsum(parts) - parts, parts)
    n = np.minimum(np.repeat(total, parts) - step * MOST_STRINGS, MOST_STRINGS)
    made = rows[own]
    begin = start[own] + step * MOST_STRINGS
    made[:, 4] = begin << _START_BITS | n >> 7 << _PLACE_BITS | _KNOWN | (n & (_KNOWN - 1))
    made[:, 0] = S.mix((made[:, 3] * 1_000_003 + made[:, 4]).view(np.uint64)).view(np.int64)
    made[:, 1] = 0
    return made


def shape_of(spot):
    """The anchor's place and the number of strings, which equal segments have in common."""
    return spot & ((1 << _START_BITS) - 1)


def fold(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first segment of each kind, with those that have no equal; and the others, as known repeats."""
    keys = S.mix(rows[:, 0].view(np.uint64) ^ S.mix(rows[:, 1].view(np.uint64)))
    order = np.argsort(keys)
    same = np.zeros(len(order), bool)
    same[1:] = keys[order[1:]] == keys[order[:-1]]
    grouped = same.copy()
    grouped[:-1] |= same[1:]
    at = order[grouped]
    shape = shape_of(rows[at, 4])
    by_kind = np.lexsort((rows[at, 4], rows[at, 3], shape, rows[at, 1], rows[at, 0]))
    at, shape = at[by_kind], shape[by_kind]
    if not len(at):
        return rows, rows[:0]
    new = np.ones(len(at), bool)
    new[1:] = (rows[at[1:], :2] != rows[at[:-1], :2]).any(axis=1) | (shape[1:] != shape[:-1])
    first = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
    later = (rows[at, 3] != rows[first, 3]) | (rows[at, 4] != rows[first, 4])
    known = np.zeros(len(rows), bool)
    known[at[later]] = True
    return rows[~known], repeats_joined(rows[known])


@tidy
def found_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All segments of the texts; of equal ones in a batch, all but the first are flagged as known."""
    for batch in batches:
        ids = batch.column("id").to_numpy()
        tids = batch.column("tid").to_numpy()
        parts, known = [np.zeros((0, 5), np.int64)], []
        for whole in S.chunks(batch.column("text")):
            for chunk, at in pieces_of(whole):
                text, start, place, count, anchor, hashes = segments(chunk)
                text += chunk.first
                spot = (start + at) << _START_BITS | place << _PLACE_BITS | count
                rows = np.column_stack([anchor.view(np.int64), hashes.view(np.int64), tids[text], ids[text], spot])
                if len(rows) * DENSE > len(chunk.data):  # not prose; most of it repeats what is near
                    rows, joined = fold(rows)
                    known.append(joined)
                parts.append(rows)
        rows, joined = fold(np.concatenate(parts))
        rows = np.concatenate([rows, joined, *known])
        # many at once would take as much memory again on their way out
        for at in range(0, max(1, len(rows)), SENT_ROWS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in rows[at : at + SENT_ROWS].T], ["anchor", "hash", "tid", "id", "spot"]
            )


@tidy
def sift_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments in order of anchor, hash, shape, id and start: known repeats, and those to be sorted.

    A segment is a known repeat if an equal one is earlier, and to be sorted if it is the first of its kind
    and its anchor has another kind. All that is kept between batches is the last kind's first row and the
    row that waits for its anchor's next kind.
    """
    last = None  # the first row of the last kind
    waiting = None  # the only kind of the last anchor so far
    for batch in batches:
        rows = np.column_stack([c.to_numpy() for c in batch.columns])
        known = rows[:, 4] & _KNOWN > 0
        out = [rows[known]]
        live = rows[~known]
        sorted_rows = np.zeros((0, 5), np.int64)
        if len(live):
            shape = shape_of(live[:, 4])
            new_anchor = np.ones(len(live), bool)
            new_anchor[1:] = live[1:, 0] != live[:-1, 0]
            new_kind = new_anchor.copy()
            new_kind[1:] |= (live[1:, 1] != live[:-1, 1]) | (shape[1:] != shape[:-1])
            if last is not None and live[0, 0] == last[0]:
                new_anchor[0] = False
                new_kind[0] = live[0, 1] != last[1] or shape[0] != shape_of(last[4])
            at = np.maximum.accumulate(np.where(new_kind, np.arange(len(live)), -1))
            first_id, first_spot = live[at, 3], live[at, 4]
            if at[0] < 0:
                first_id, first_spot = (np.where(at < 0, x, y) for x, y in zip(last[3:], (first_id, first_spot), strict=True))
            later = live[~new_kind & ((live[:, 3] != first_id) | (live[:, 4] != first_spot))]
            later[:, 4] &= ~(255 << _PLACE_BITS)
            out.append(later)
            kinds = np.flatnonzero(new_kind)
            if len(kinds):
                lead = new_anchor[kinds]
                chosen = ~lead
                chosen[:-1] |= ~lead[1:]
                held = [waiting] if waiting is not None and not lead[0] else []
                sorted_rows = np.concatenate([np.array(held, np.int64).reshape(-1, 5), live[kinds[chosen]]])
                waiting = live[kinds[-1]] if lead[-1] else None
                last = live[kinds[-1]]
        repeats = np.concatenate(out)
        every = np.concatenate([repeats, sorted_rows])
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(every[:, c]) for c in (0, 2, 3, 4)),
                pa.array(np.arange(len(every)) >= len(repeats)),
            ],
            ["anchor", "tid", "id", "spot", "open"],
        )


@tidy
def cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each open segment of the anchors that go to shards."""
    for batch in batches:
        out: list[tuple] = []
        texts = batch.column("text")
        for i, marks in enumerate(batch.column("marks").to_pylist()):
            wanted = [m for m in marks if m["open"] and not m["many"]]
            if not wanted:
                continue
            data = texts[i].as_buffer().to_pybytes()
            row = (batch.column("id")[i].as_py(), batch.column("tid")[i].as_py())
            for m in wanted:
                start, count = start_of(m["spot"]), count_of(m["spot"])
                place = m["spot"] >> _PLACE_BITS & 255
                out.append((m["anchor"], *row, start, place, count, data[start : start + count - 1 + LENGTH]))
        columns = list(zip(*out, strict=True)) if out else [[]] * 7
        kinds = [pa.int64()] * 6 + [pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["anchor", "id", "tid", "start", "place", "n", "bytes"],
        )


@tidy
def fold_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and first place of each different string of the anchors of very many segments.

    Strings are folded some at a time. Texts that share an id can have the same first place.
    """
    held: dict[bytes, tuple[tuple[int, int], list[int]]] = {}

    def emit() -> pa.RecordBatch:
        rows = [
            (int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), *at, tid)
            for h, (at, tids) in held.items()
            for tid in tids
        ]
        held.clear()
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["high", "low", "id", "start", "tid"]
        )

    for batch in batches:
        texts = batch.column("text")
        for i, marks in enumerate(batch.column("marks").to_pylist()):
            wanted = [m["spot"] for m in marks if m["many"]]
            if not wanted:
                continue
            data = texts[i].as_buffer().to_pybytes()
            row_id, tid = batch.column("id")[i].as_py(), batch.column("tid")[i].as_py()
            for spot in wanted:
                for start in range(start_of(spot), start_of(spot) + count_of(spot)):
                    key = hashlib.blake2b(data[start : start + LENGTH], digest_size=16).digest()
                    at, known = (row_id, start), held.get(key)
                    if known is None or at < known[0]:
                        held[key] = (at, [tid])
                    elif at == known[0]:
                        known[1].append(tid)
                if len(held) >= FOLD_STRINGS:
                    yield emit()
    yield emit()


def alike(joined: np.ndarray, heads: np.ndarray, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Flags of the segments' strings, one after another, that another segment may hold as well.

    Strings that begin up to ``CORE_STEP`` bytes apart, counted from the anchor, share their middle. Equal
    strings lie alike around equal anchors, so a string whose middle no other segment has is met nowhere.
    """
    first = (places - counts + 1) // CORE_STEP
    bins = places // CORE_STEP - first + 1
    owner = np.repeat(np.arange(len(heads)), bins)
    number = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(bins) - bins, bins)
    anchor = heads[owner] + places[owner]
    begin = anchor - number * CORE_STEP
    hashes = S.hash_between(
        S.running_hash(joined), begin, begin - CORE_STEP + 1 + LENGTH
    ) + number.astype(np.uint64)
    _, inverse, held = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = held[inverse] > 1
    segment = np.repeat(np.arange(len(heads)), counts)
    inner = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    own_bin = (places[segment] - inner) // CORE_STEP - first[segment]
    return shared[(np.cumsum(bins) - bins)[segment] + own_bin]


def later_strings(
    ids: np.ndarray, starts: np.ndarray, places: np.ndarray, counts: np.ndarray, pieces: pa.Array
) -> np.ndarray:
    """Flags of the segments' strings, one after another, that equal one of an earlier (id, start).

    Only stretches of strings that may be met elsewhere are sorted.
    """
    joined, ends = np.frombuffer(b"".join(pieces.to_pylist()), np.uint8), np.cumsum(counts + LENGTH - 1)
    heads = ends - counts - LENGTH + 1
    maybe = np.flatnonzero(alike(joined, heads, places, counts))
    later = np.zeros(int(counts.sum()), bool)
    if not len(maybe):
        return later
    segment = np.repeat(np.arange(len(ids)), counts)
    inner = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    new = np.ones(len(maybe), bool)
    new[1:] = (maybe[1:] != maybe[:-1] + 1) | (segment[maybe[1:]] != segment[maybe[:-1]])
    lead = maybe[new]
    lengths = np.diff(np.append(np.flatnonzero(new), len(maybe)))
    at = segment[lead]
    later[maybe] = sorted_later(
        ids[at], starts[at] + inner[lead], lengths, joined, heads[at] + inner[lead]
    )
    return later


def sorted_later(
    ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, joined: np.ndarray, origins: np.ndarray
) -> np.ndarray:
    """As ``later_strings``, of the stretches that begin at the origins, by their suffix array."""
    sizes = counts + LENGTH
    heads = np.cumsum(sizes) - sizes
    text = np.ones(int(sizes.sum()) + 1, np.int64)  # 1 after each stretch, 0 at the end
    text[-1] = 0
    within = np.arange(int((sizes - 1).sum())) - np.repeat(np.cumsum(sizes - 1) - sizes + 1, sizes - 1)
    text[np.repeat(heads, sizes - 1) + within] = joined[np.repeat(origins, sizes - 1) + within] + np.int64(2)
    sa = suffix_array(text)
    _, common = permuted_common_prefixes(text, sa, heads, 3 * LENGTH)
    # strings by place: which begin within the first n of their segment
    number = np.full(len(text), -1, np.int64)
    total = int(counts.sum())
    inner = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    number[np.repeat(heads, counts) + inner] = np.arange(total)
    own_id, own_start = np.repeat(ids, counts), np.repeat(starts, counts) + inner
    order = np.lexsort((own_start, own_id))
    step = (np.diff(own_id[order]) != 0) | (np.diff(own_start[order]) != 0)
    rank = np.empty(total, np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(step)])
    at = sa[number[sa] >= 0]
    strings = number[at]
    new = common[at] < LENGTH
    new[0] = True
    least = np.minimum.reduceat(rank[strings], np.flatnonzero(new))[np.cumsum(new) - 1]
    later = np.zeros(total, bool)
    later[strings] = rank[strings] > least
    return later


@tidy
def sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From segments in order of their anchors: the runs of strings that repeat earlier ones."""
    held: list[pa.RecordBatch] = []
    size = 0

    def mark(rows: pa.Table) -> pa.RecordBatch:
        ids, starts, places, counts = (rows[c].to_numpy() for c in ("id", "start", "place", "n"))
        later = later_strings(ids, starts, places, counts, rows["bytes"])
        owners = [np.repeat(rows[c].to_numpy(), counts) for c in ("id", "tid")]
        place = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(len(later))
        segment = np.repeat(np.arange(len(ids)), counts)
        at = np.flatnonzero(later)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (segment[at[1:]] != segment[at[:-1]])
        begin = at[new]
        count = np.diff(np.append(np.flatnonzero(new), len(at)))
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x[begin]) for x in owners), pa.array(place[begin]), pa.array(count, pa.int64())],
            ["id", "tid", "start", "n"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < SHARD_BYTES:
            continue
        rows = pa.Table.from_batches(held)
        edges = np.flatnonzero(np.diff(rows["anchor"].to_numpy())) + 1  # where shards can be parted
        grown = np.cumsum(pa.compute.binary_length(rows["bytes"]).to_numpy())
        begin = 0
        while len(edges):
            wanted = (grown[begin - 1] if begin else 0) + SHARD_BYTES
            ready = edges[(edges > begin) & (grown[edges - 1] >= wanted)]
            if not len(ready):
                break
            yield mark(rows.slice(begin, ready[0] - begin))
            begin = int(ready[0])
        held = rows.slice(begin).to_batches()
        size = int(grown[-1] - (grown[begin - 1] if begin else 0))
    if held:
        yield mark(pa.Table.from_batches(held))


def _covered(n_bytes: int, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and ends of the longest stretches that strings from these starts cover."""
    ends = np.minimum(starts + counts - 1 + LENGTH, n_bytes)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


def first_strings(touched: DataFrame) -> DataFrame:
    """Where in each text strings of the anchors of very many segments are the first of their kind."""
    strings = touched.where(F.exists("marks", lambda m: m["many"])).mapInArrow(
        fold_strings, "high bigint, low bigint, id bigint, start bigint, tid bigint"
    )
    strings = strings.repartition("high", "low")  # read twice, shuffled once
    least = strings.groupBy("high", "low").agg(F.min(F.struct("id", "start", "tid")).alias("least"))
    first = (F.col("id") == F.col("least.id")) & (F.col("start") == F.col("least.start"))
    firsts = strings.join(least, ["high", "low"]).where(first)
    return firsts.groupBy("id", "tid").agg(F.collect_list("start").alias("firsts"))


def cut(documents: DataFrame, with_text: bool) -> tuple[DataFrame, DataFrame]:
    """The rows with their ``id`` and ``tid``, and what is left of each text that repeats something.

    The second has id, tid, n_removed, n_spans, kept_sha256 and, ``with_text``, kept (what is left,
    without characters cut in half), one row for each different (id, text) that loses bytes.
    """
    rows = documents.withColumn("id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)))
    rows = rows.withColumn("_text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("tid", F.xxhash64("_text"))
    texts = rows.select("id", "tid", F.col("_text").alias("text"))
    found = texts.mapInArrow(found_segments, ROW)
    shape = F.col("spot").bitwiseAND(shape_of(-1))
    dealt = found.repartition("anchor").sortWithinPartitions("anchor", "hash", shape, "id", "spot")
    sifted = stored(dealt.mapInArrow(sift_segments, SIFTED))
    many = sifted.where("open").groupBy("anchor").agg(F.count("*").alias("held"))
    many = stored(many.where(F.col("held") > SHARD_SEGMENTS).select("anchor", F.lit(True).alias("many")))
    parted = sifted.join(many, "anchor", "left")
    parted = parted.withColumn("many", F.col("open") & F.coalesce("many", F.lit(False)))
    marks = parted.groupBy("id", "tid").agg(
        F.collect_list(F.struct("anchor", "spot", "open", "many")).alias("marks")
    )
    same = ["id", "tid"]
    # read more than once below, but shuffled once: every time in the same way
    touched = texts.join(marks, same).dropDuplicates(same)
    pieces = touched.mapInArrow(
        cut_segments,
        "anchor bigint, id bigint, tid bigint, start bigint, place bigint, n bigint, bytes binary",
    )
    pieces = pieces.repartition("anchor").sortWithinPartitions("anchor")
    runs = pieces.mapInArrow(sort_shards, "id bigint, tid bigint, start bigint, n bigint")
    runs = runs.groupBy(*same).agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    marked = touched.join(runs, same, "left")
    if many.isEmpty():
        marked = marked.withColumn("firsts", F.lit(None).cast("array<bigint>"))
    else:
        marked = marked.join(first_strings(touched), same, "left")

    @tidy
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("id", "tid", "marks", "runs", "firsts")]
            for i, (row_id, tid, marks, runs, firsts) in enumerate(zip(*columns, strict=True)):
                spots = np.array([m["spot"] for m in marks if not m["open"]], np.int64)
                found = np.array([(r["start"], r["n"]) for r in runs or []], np.int64).reshape(-1, 2)
                folded = [np.arange(count_of(m["spot"])) + start_of(m["spot"]) for m in marks if m["many"]]
                folded = np.setdiff1d(np.concatenate(folded), firsts or []) if folded else spots[:0]
                starts = np.concatenate([start_of(spots), found[:, 0], folded])
                counts = np.concatenate([long_count_of(spots), found[:, 1], np.ones(len(folded), np.int64)])
                data = batch.column("text")[i].as_buffer().to_pybytes()
                fits = starts + LENGTH <= len(data)
                if not fits.any():
                    continue
                begins, ends = _covered(len(data), starts[fits], counts[fits])
                left = b"".join(
                    data[a:b] for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(data)], strict=True)
                )
                kept = left.decode("utf-8", "ignore") if with_text else None
                sha = hashlib.sha256(left).hexdigest()
                out.append((row_id, tid, int((ends - begins).sum()), len(begins), sha, kept))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["id", "tid", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    changed = marked.select("id", "tid", "text", "marks", "runs", "firsts").mapInArrow(
        remove, "id bigint, tid bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"
    )
    return rows, changed


def repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each text."""
    rows, changed = cut(documents.select("doc_id", "text"), with_text=False)
    counted = rows.select(
        "doc_id", "id", "tid", F.octet_length("_text").cast("bigint").alias("n_bytes"),
        F.sha2(F.col("_text"), 256).alias("whole_sha256"),
    )
    joined = counted.join(changed.drop("kept"), ["id", "tid"], "left")
    return joined.select(
        "doc_id", "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


def without_repeats(documents: DataFrame) -> DataFrame:
    """The rows with their columns; from ``text``, what repeats is gone, and characters cut in half."""
    names = [f"_c{i}" for i in range(len(documents.columns))]
    renamed = documents.toDF(*names)
    place = {c: n for c, n in zip(documents.columns, names, strict=True)}
    plain = renamed.withColumn("doc_id", F.col(place["doc_id"])).withColumn("text", F.col(place["text"]))
    rows, changed = cut(plain, with_text=True)
    texts = changed.select("id", "tid", "kept")
    joined = rows.join(texts, ["id", "tid"], "left")
    return joined.select(
        *(
            (F.coalesce("kept", "text") if c == "text" else F.col(n)).alias(c)
            for c, n in place.items()
        )
    )
