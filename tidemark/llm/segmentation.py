"""SentencePiece encoding with sampled segmentations, and decoding.

The lattice of a text has an edge for every vocabulary piece that matches at some place; characters that
no piece covers are spelt in byte pieces. An edge's weight is its piece's share of a Zipf law over the
vocabulary's merge ranks, sharpened by ``theta``; a segmentation's probability is the product of its edges
over the sum of all. ``K`` distinct segmentations of each text are drawn by Gumbel top-k without
replacement, as a best-first search over perturbed scores: a node of the search is all segmentations
that share their first choices; it holds the largest perturbed score among them. Taking the best node
apart gives one segmentation and, at each of its choices, a node of all that choose otherwise there,
whose score is drawn below the score of the node they came from. Scores come with the log of the chance
that a segmentation is drawn at all, given the best score left.

No piece reaches across the beginning of a run of blanks, so the lattice falls into words; the sums of
each different word of a chunk are worked out once, for all words together, one character at a time, and
paths are drawn for all texts of the chunk together. Random numbers are hashes of the row's key, the
word's number and the step, so results do not depend on how rows are batched.

Defined results: a null or empty text has one segmentation, without pieces; texts with fewer than ``K``
segmentations give all they have; repeated rows give the same segmentations; a null key counts as -1.
Blanks become the piece mark before encoding and the mark becomes a blank in decoding, so that a text
that holds the mark itself does not come back as it was; all others do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans as S
from tidemark.llm.rows import tidy

K = 2
THETA = 1.0
ZIPF_SHIFT = 2.7
OUT_OF_REACH = 60.0  # a Gumbel number exceeds another that far only once in e**60
MARK = "▁"
CHUNK_BYTES = 1 << 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 20  # bits of the table that finds pieces by their hash


class Vocabulary:
    """Pieces by the hash of their characters, their log weights, and the bytes they decode to."""

    def __init__(self, path: str, theta: float = THETA) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_ids = np.zeros(256, np.int64)
        pieces, ids, ranks = [], [], []
        spelt = [b""] * n
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                spelt[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.append(piece)
                ids.append(i)
                ranks.append(-model.get_score(i))
                spelt[i] = piece.replace(MARK, " ").encode()
        ranks = np.argsort(np.argsort(np.array(ranks), kind="stable"), kind="stable")
        weights = 1 / (ranks + ZIPF_SHIFT)
        logs = np.log(weights / weights.sum()) * theta
        self.spell_byte = float(logs.min()) - 1.0  # log weight of one spelt byte
        self.longest = max(map(len, pieces))
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(p) for p in pieces])
        keys = _plain_between(_running(points), ends - [len(p) for p in pieces], ends) * _SPREAD
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], np.append(logs[order], -np.inf)
        self.ids = np.append(np.array(ids)[order], -1)
        slots = (self.keys >> np.uint64(64 - _SLOTS)).astype(np.int64)
        self.slot = np.full(1 << _SLOTS, -1, np.int32)  # the first of the pieces of each slot
        self.slot[slots[::-1]] = np.arange(len(slots), dtype=np.int32)[::-1]
        self.most = int(np.bincount(slots).max())
        self.single = np.zeros(0x110000, bool)
        self.single[[ord(p) for p in pieces if len(p) == 1]] = True
        self.spelt_size = np.array([len(b) for b in spelt])
        self.spelt_end = np.cumsum(self.spelt_size)
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the plain hashes are pieces', and their places in ``ids`` and ``logs``."""
        keys = hashes * _SPREAD
        first = self.slot[(keys >> np.uint64(64 - _SLOTS)).astype(np.int64)]
        likely = np.flatnonzero(first >= 0)
        place, wanted = first[likely].astype(np.int64), keys[likely]
        for _ in range(self.most - 1):  # pieces of a slot are neighbours in order of their hashes
            place += self.keys[place] < wanted
            np.minimum(place, len(self.keys) - 1, out=place)
        hit = self.keys[place] == wanted
        return likely[hit], place[hit]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The texts of segmentations that stand one after another, as UTF-8."""
        n = self.spelt_size[ids]
        after = np.cumsum(n)
        at = np.repeat(self.spelt_end[ids] - after, n) + np.arange(after[-1] if len(after) else 0)
        spelt = self.spelt[at].tobytes()
        cuts = np.concatenate([[0], after])[np.concatenate([[0], ends])].tolist()
        return [spelt[a + 1 : b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _running(points: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(S.mix(points.astype(np.uint64) + np.uint64(1)) * S.powers(len(points))[0], out=sums[1:])
    return sums


def _plain_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = S.powers(len(sums))[1]
    return (sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)


def _uniform(seeds: np.ndarray, words: np.ndarray, steps: np.ndarray, use: int) -> np.ndarray:
    """Numbers inside (0, 1) from the hash of a row's seed, a word's number, a step in it, and the use."""
    place = words.astype(np.uint64) << np.uint64(24) | steps.astype(np.uint64)
    mixed = S.mix(seeds + S.mix(place * np.uint64(0x9DDFEA08EB382D69) + np.uint64(use)))
    return ((mixed >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _below(location: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel numbers with these locations, given that they lie below ``top``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        drawn = location - np.logaddexp(location - top, np.log(-np.log(u)))
    return np.where(np.isneginf(location), -np.inf, drawn)


@dataclass
class Lattice:
    """The words of a chunk's texts, and the edges of each different word.

    Different words are ranked by falling length; place ``base[t] + rank`` lies behind the first t
    characters of a word, so that the places of one t, of all words that long, are neighbours. The edges
    that end at place p are ``first[p]`` to ``first[p + 1] - 1``, the longest first. An edge's share
    is the chance that a path from the word's beginning to the place ends with it: ``log`` is its logarithm,
    ``upto`` the running sum of shares at the place, ``others`` the sum of the other shares there.
    """

    owner: np.ndarray  # text of each word
    number: np.ndarray  # number of each word within its text
    rank: np.ndarray  # rank of each word's different word
    size: np.ndarray  # characters of each word
    base: np.ndarray
    first: np.ndarray
    length: np.ndarray  # characters of each edge
    piece: np.ndarray  # its piece's id; for a character spelt in bytes, -1 - the character
    log: np.ndarray
    upto: np.ndarray
    others: np.ndarray


def lattice(texts: list[str], vocabulary: Vocabulary) -> Lattice:
    marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
    points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t) for t in marked], np.int64)
    is_mark = points == ord(MARK)
    begins = np.zeros(len(points), bool)
    begins[1:] = is_mark[1:] & ~is_mark[:-1]
    spelt = ~vocabulary.single[points]  # characters that only bytes spell are words by themselves
    begins |= spelt
    begins[1:] |= spelt[:-1]
    begins[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(points))[: len(starts)]
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    number = np.arange(len(starts)) - np.searchsorted(owner, np.arange(len(texts)))[owner]
    hashes = S.mix(_plain_between(_running(points), starts, ends))
    _, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    by_size = np.argsort(starts[sample] - ends[sample], kind="stable")
    rank = np.empty(len(sample), np.int64)
    rank[by_size] = np.arange(len(sample))
    begin, size = starts[sample][by_size], (ends - starts)[sample][by_size]
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(longest + 1), side="right")  # words of at least t characters
    live[0] = len(size)
    base = np.cumsum(live) - live
    sums = [np.zeros(len(size), np.uint64)]  # running hashes of the last t, as far back as pieces reach
    total_log = np.zeros(int(live.sum()))  # log of the sum over the paths from the word's beginning
    powers, inverses = S.powers(longest + 1)
    edges: list[tuple] = []
    counts = [np.zeros(len(size), np.int64)]
    for t in range(1, longest + 1):
        n_live = live[t]
        last = points[begin[:n_live] + t - 1]
        value = S.mix(last.astype(np.uint64) + np.uint64(1)) * powers[t - 1]
        sums.append(sums[-1][:n_live] + value)
        back = min(vocabulary.longest, t)
        keys = np.empty((n_live, back), np.uint64)
        for n in range(1, back + 1):
            np.subtract(sums[-1], sums[-1 - n][:n_live], out=keys[:, back - n])
            keys[:, back - n] *= inverses[t - n]
            keys[:, back - n] += np.uint64(n)
        if len(sums) > vocabulary.longest:
            sums.pop(0)
        at, place = vocabulary.find(keys.ravel())
        row, column = np.divmod(at, back)
        if t == 1 and len(row) < n_live:  # the others are characters spelt in bytes
            found, row, column = place, np.arange(n_live), np.zeros(n_live, np.int64)
            place = np.full(n_live, len(vocabulary.keys))
            place[at] = found
        length, log, piece = back - column, vocabulary.logs[place], vocabulary.ids[place]
        spelt = np.flatnonzero(place == len(vocabulary.keys))
        if len(spelt):
            point = last[row[spelt]].astype(np.int64)
            log[spelt] = vocabulary.spell_byte * (1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))
            piece[spelt] = -1 - point
        ways = log + total_log[base[t - length] + row]
        many = np.bincount(row, minlength=n_live)
        head = np.cumsum(many) - many
        most = np.maximum.reduceat(ways, head)
        share = np.exp(ways - most[row])
        whole = np.add.reduceat(share, head)
        share /= whole[row]
        whole = most + np.log(whole)
        total_log[base[t] : base[t] + n_live] = whole
        ways -= whole[row]
        large = share > 0.9
        rest = np.add.reduceat(np.where(large, 0.0, share), head)[row]
        others = np.where(large, rest, 1.0 - share)
        upto = np.cumsum(share)
        upto = upto - (upto[head] - share[head])[row]
        upto[head + many - 1] = 2.0
        edges.append(
            (length.astype(np.int16), piece.astype(np.int32), ways, upto.astype(np.float32), others)
        )
        counts.append(many)
    first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    kinds = (np.int16, np.int32, np.float64, np.float32, np.float64)
    columns = []
    for i, kind in enumerate(kinds):
        columns.append(np.concatenate([np.zeros(0, kind), *(e[i] for e in edges)]))
        edges = [(*e[:i], None, *e[i + 1 :]) for e in edges]  # each column is held once
    return Lattice(owner, number, rank[inverse], size[rank[inverse]], base, first, *columns)


@dataclass
class Paths:
    """Choices of one segmentation of each text, by word and, within a word, from its end."""

    word: np.ndarray
    step: np.ndarray
    left: np.ndarray  # characters of the word up to the edge's end
    edge: np.ndarray
    fresh: np.ndarray  # whether it was drawn for this path, not taken over

    def columns(self) -> list[np.ndarray]:
        return [self.word, self.step, self.left, self.edge, self.fresh]


def _walk(
    lat: Lattice, words: np.ndarray, left: np.ndarray, steps: np.ndarray, seeds: np.ndarray, turn: int
) -> list[np.ndarray]:
    """Draw the rest of the paths of these words, of which ``left`` characters are still open."""
    found = [[np.zeros(0, np.int64)] * 4]
    while True:
        live = left > 0
        words, left, steps = words[live], left[live], steps[live]
        if not len(words):
            break
        u = _uniform(seeds[lat.owner[words]], lat.number[words], steps, turn)
        edge = lat.first[lat.base[left] + lat.rank[words]]
        beyond = np.flatnonzero(u > lat.upto[edge])
        while len(beyond):
            edge[beyond] += 1
            beyond = beyond[u[beyond] > lat.upto[edge[beyond]]]
        found.append([words, steps, left, edge])
        left, steps = left - lat.length[edge], steps + 1
    columns = [np.concatenate(x) for x in zip(*found, strict=True)]
    return [*columns, np.ones(len(columns[0]), bool)]


def _ordered(parts: list[list[np.ndarray]], n_words: int) -> Paths:
    """The choices in order of words and steps."""
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    counts = np.bincount(columns[0], minlength=n_words)
    at = (np.cumsum(counts) - counts)[columns[0]] + columns[1]
    out = [np.empty_like(c) for c in columns]
    for placed, column in zip(out, columns, strict=True):
        placed[at] = column
    return Paths(*out)


def _open(lat: Lattice, places: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Shares of the edges at these places, by their order there; 0 for those in the masks."""
    n = lat.first[places + 1] - lat.first[places]
    shares = np.zeros((len(places), int(n.max()) if len(n) else 1))
    for k in range(shares.shape[1]):
        at = np.flatnonzero((n > k) & (masks >> k & 1 == 0))
        shares[at, k] = np.exp(lat.log[lat.first[places[at]] + k])
    return shares


@dataclass
class Drawn:
    """The segmentations drawn in one turn, for the texts that have one."""

    texts: np.ndarray
    paths: Paths
    log_prob: np.ndarray
    perturbed: np.ndarray


def draw(lat: Lattice, seeds: np.ndarray, k: int) -> tuple[list[Drawn], list[np.ndarray]]:
    """Up to k segmentations of each text, by falling perturbed score; and the best score left after each."""
    n, n_words = len(seeds), len(lat.owner)
    texts, words = np.arange(n), np.arange(n_words)
    seeds = S.mix(seeds.astype(np.uint64))
    zeros = np.zeros(n, np.int64)
    top = -np.log(-np.log(_uniform(seeds, zeros, zeros, 0x70)))
    paths = _ordered([_walk(lat, words, lat.size, np.zeros(n_words, np.int64), seeds, 0)], n_words)
    turns: list[Drawn] = []
    left_best: list[np.ndarray] = []
    # open nodes: text, score, turn whose path they leave, choice where they do, edges not open there
    kinds = (np.int64, np.float64, np.int8, np.int64, np.int64)
    nodes = [np.zeros(0, kind) for kind in kinds]
    for turn in range(k):
        owner = lat.owner[paths.word]
        sums = np.concatenate([[0.0], np.cumsum(lat.log[paths.edge])])
        bounds = np.searchsorted(owner, np.arange(n + 1))
        begin, end = bounds[:-1], bounds[1:]
        turns.append(Drawn(texts, paths, (sums[end] - sums[begin])[texts], top[texts]))
        # scores lie about their locations; a node far below another one cannot be the best of its text
        prefix = sums[:-1] - sums[begin[owner]]
        new = np.flatnonzero(paths.fresh & (prefix > -2 * OUT_OF_REACH))
        with np.errstate(divide="ignore"):
            location = prefix[new] + np.log(lat.others[paths.edge[new]])
            best_location = np.full(n, -np.inf)
            np.maximum.at(best_location, owner[new], location)
            further = paths.fresh & (prefix <= -2 * OUT_OF_REACH)
            further = np.flatnonzero(further & (best_location < -OUT_OF_REACH)[owner])
            new = np.concatenate([new, further])
            location = np.concatenate([location, prefix[further] + np.log(lat.others[paths.edge[further]])])
        reached = (location > best_location[owner[new]] - OUT_OF_REACH) & (location > -np.inf)
        new, location = new[reached], location[reached]
        own, word = owner[new], paths.word[new]
        u = _uniform(seeds[own], lat.number[word], paths.step[new], 0x1000 + turn)
        place = lat.base[paths.left[new]] + lat.rank[word]
        masks = 1 << (paths.edge[new] - lat.first[place])
        added = (own, _below(location, top[own], u), np.full(len(new), turn), new, masks)
        nodes = [
            np.concatenate([a, b.astype(kind)]) for a, b, kind in zip(nodes, added, kinds, strict=True)
        ]
        best = np.full(n, -np.inf)
        np.maximum.at(best, nodes[0], nodes[1])
        left_best.append(best)
        if turn + 1 == k:
            break
        picked = np.flatnonzero(nodes[1] == best[nodes[0]])
        texts, one = np.unique(nodes[0][picked], return_index=True)
        picked = picked[one]  # one node a text
        word, step, left = (np.zeros(len(picked), np.int64) for _ in range(3))
        prefix = np.zeros(len(picked))
        parts = []
        for t in range(turn + 1):
            mine = np.flatnonzero(nodes[2][picked] == t)
            old, at = turns[t].paths, nodes[3][picked[mine]]
            word[mine], step[mine], left[mine] = old.word[at], old.step[at], old.left[at]
            cut = np.zeros(n, np.int64)  # choices before it are taken over
            cut[texts[mine]] = at
            keep = np.flatnonzero(np.arange(len(old.word)) < cut[lat.owner[old.word]])
            logs = np.bincount(lat.owner[old.word[keep]], lat.log[old.edge[keep]], n)
            prefix[mine] = logs[texts[mine]]
            parts.append([*(c[keep] for c in old.columns()[:4]), np.zeros(len(keep), bool)])
        place = lat.base[left] + lat.rank[word]
        masks = nodes[4][picked]
        running = np.cumsum(_open(lat, place, masks), axis=1)
        u = _uniform(seeds[texts], lat.number[word], step, 0x2000 + turn) * running[:, -1]
        order = (running < u[:, None]).sum(axis=1)
        edge = lat.first[place] + order
        parts.append([word, step, left, edge, np.zeros(len(word), bool)])
        # the node goes on with what is still open there
        masks = masks | 1 << order
        rest = _open(lat, place, masks).sum(axis=1)
        u = _uniform(seeds[texts], lat.number[word], step, 0x3000 + turn)
        with np.errstate(divide="ignore"):
            nodes[1][picked] = _below(prefix + np.log(rest), best[texts], u)
        nodes[4][picked] = masks
        live = ~np.isneginf(nodes[1])
        nodes = [x[live] for x in nodes]
        top = best
        # the rest of the word, and the words after it
        after = np.full(n, n_words)
        after[texts] = word
        later = np.flatnonzero(words > after[lat.owner])
        zeros = np.zeros(len(later), np.int64)
        going = (np.concatenate([word, later]), np.concatenate([left - lat.length[edge], lat.size[later]]))
        parts.append(_walk(lat, *going, np.concatenate([step + 1, zeros]), seeds, turn + 1))
        paths = _ordered(parts, n_words)
    return turns, left_best


def path_ids(lat: Lattice, paths: Paths, n: int, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts' segmentations in reading order, and where each text's end."""
    counts = np.bincount(paths.word, minlength=len(lat.owner))
    first = np.cumsum(counts) - counts
    order = first[paths.word] + counts[paths.word] - 1 - paths.step
    piece = np.empty(len(order), np.int64)
    piece[order] = lat.piece[paths.edge]
    owner = lat.owner[paths.word]  # the same for all choices of a word
    bare = np.flatnonzero(piece < 0)
    if len(bare):
        spelt = [chr(-1 - p).encode() for p in piece[bare].tolist()]
        extra = np.ones(len(piece), np.int64)
        extra[bare] = [len(b) for b in spelt]
        piece, owner = np.repeat(piece, extra), np.repeat(owner, extra)
        piece[piece < 0] = vocabulary.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
    return piece, np.cumsum(np.bincount(owner, minlength=n))


def log_inclusion(log_prob: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Log of the chance that a perturbed score exceeds the best one left."""
    gap = log_prob - left
    with np.errstate(divide="ignore", over="ignore"):
        near = np.log(-np.expm1(-np.exp(np.minimum(gap, 700.0))))
    return np.where(gap < -30, gap, near)


_vocabularies: dict[tuple[str, float], Vocabulary] = {}


def vocabulary(path: str, theta: float = THETA) -> Vocabulary:
    if (path, theta) not in _vocabularies:
        _vocabularies[path, theta] = Vocabulary(path, theta)
    return _vocabularies[path, theta]


def copy_numbers(batch: pa.RecordBatch, last: tuple | None) -> tuple[np.ndarray, tuple | None]:
    """Which copy of a row each row of a batch is, from 1 on; ``last`` is the row before, and its number."""
    if not batch.num_rows:
        return np.zeros(0, np.int64), last
    doc_id, text = batch.column("doc_id"), batch.column("text")
    same = np.zeros(batch.num_rows, bool)
    known = doc_id.fill_null(-1).to_numpy(zero_copy_only=False)
    unnamed = doc_id.is_null().to_numpy(zero_copy_only=False)
    same[1:] = (known[1:] == known[:-1]) & (unnamed[1:] == unnamed[:-1])
    at = np.flatnonzero(same)
    equal = pc.equal(text.take(pa.array(at)), text.take(pa.array(at - 1)))
    same[at] = equal.to_numpy(zero_copy_only=False)
    begun = 0
    if last is not None and last[:2] == (doc_id[0].as_py(), text[0].as_py()):
        begun = last[2]
    number = np.arange(batch.num_rows) - np.maximum.accumulate(np.where(same, 0, np.arange(batch.num_rows))) + 1
    number[np.logical_and.accumulate(same | (np.arange(batch.num_rows) == 0))] += begun
    return number, (doc_id[-1].as_py(), text[-1].as_py(), int(number[-1]))


def encode(
    documents: DataFrame,
    model: str,
    k: int = K,
    theta: float = THETA,
    with_ids: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
    with_copies: bool = False,
) -> DataFrame:
    """A row for each text and drawn segmentation, numbered by ``sample`` from 1.

    With ``with_copies``, rows that repeat the row before them (id and text) are further copies of it: ``copy`` counts
    them from 1, and each copy draws segmentations of its own. Copies are to stand next to each other, as ``mixing``
    writes them.

    ``chunk_bytes`` of text are worked on at a time; less takes less memory and somewhat more time.

    n_pieces, log_prob, perturbed score, log_inclusion, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers) and round_trip (whether the ids decode to the text); ``ids`` where asked for.
    """
    arrow = [
        ("doc_id", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("log_prob", pa.float64()),
        ("perturbed", pa.float64()), ("log_inclusion", pa.float64()), ("ids_crc32", pa.int64()),
        ("round_trip", pa.bool_()), *([("copy", pa.int32())] if with_copies else []),
        *([("ids", pa.list_(pa.int32()))] if with_ids else []),
    ]
    kinds = "doc_id bigint, sample int, n_pieces bigint, log_prob double, perturbed double, "
    kinds += "log_inclusion double, ids_crc32 bigint, round_trip boolean"

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = vocabulary(model, theta), None
        for batch in batches:
            doc_ids = batch.column("doc_id")
            keys = doc_ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.uint64)
            if with_copies:
                copy, last = copy_numbers(batch, last)
                keys += (copy - 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for chunk in S.chunks(batch.column("text"), chunk_bytes):
                raw = [
                    chunk.data[a:b].tobytes()
                    for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True)
                ]
                first = chunk.first
                lat = lattice([r.decode() for r in raw], known)
                turns, left = draw(lat, keys[first : first + chunk.n], k)
                for turn, drawn in enumerate(turns):
                    own = drawn.texts if turn else np.arange(chunk.n)
                    ids, ends = path_ids(lat, drawn.paths, chunk.n, known)
                    starts = np.concatenate([[0], ends[:-1]])
                    wide = ids.astype("<u4")
                    lists = [wide[starts[i] : ends[i]] for i in own]
                    decoded = known.decode(ids, ends)
                    inclusion = log_inclusion(drawn.log_prob, left[-1][own])
                    columns = [
                        doc_ids.take(pa.array(first + own)), np.full(len(own), turn + 1),
                        (ends - starts)[own], drawn.log_prob, drawn.perturbed, inclusion,
                        [zlib.crc32(x.tobytes()) for x in lists],
                        [decoded[i] == raw[i] for i in own],
                    ]
                    if with_copies:
                        columns.append(copy[first + own])
                    if with_ids:
                        columns.append(lists)
                    yield pa.RecordBatch.from_arrays(
                        [
                            c if isinstance(c, pa.Array) else pa.array(c, kind)
                            for c, (_, kind) in zip(columns, arrow, strict=True)
                        ],
                        schema=pa.schema(arrow),
                    )

    taken = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    kinds += ", copy int" if with_copies else ""
    return taken.mapInArrow(run, kinds + (", ids array<int>" if with_ids else ""))
