"""Quality rules: document statistics scored by gradient-boosted trees with monotonic constraints.

``statistics`` counts words, symbols, repeated lines and repeated three-word windows of every whole text.
``fit`` grows trees on the statistics of a bounded sample of labelled documents; ``Forest`` holds them as
flat node arrays and scores a whole batch of rows level by level.

Defined results: a null or empty text has no words, so it fails the base rules; repeated rows are judged
each for itself; further columns of the input are ignored; an empty table gives an empty result; without
labels of both kinds the trees are empty and only the base rules decide.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans as S
from tidemark.llm.rows import by_batch, labelled_sample

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SAMPLE_ROWS = 20_000  # labelled documents that the trees learn from, at most
REJECT_BELOW = 0.5  # documents less likely than this to be good are rejected

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_bars", "n_marks", "n_letters", "n_distinct", "n_chars")
#: Features of the trees: name, and whether quality may only fall (-1) with it or do either (0).
FEATURES = (
    ("symbols_per_word", -1),
    ("bars_per_word", -1),
    ("marks_per_word", -1),
    ("repeat_share", -1),
    ("dup_line_share", -1),
    ("upper_share", -1),
    ("word_length", 0),
    ("letter_share", 0),
    ("words_per_line", 0),
    ("distinct_share", 0),
)

_letter = np.zeros(256, bool)
_letter[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _bytes(text: bytes) -> np.ndarray:
    member = np.zeros(256, bool)
    member[list(text)] = True
    return member


_SYMBOLS, _BARS, _MARKS = _bytes(b"#*$%&|<>"), _bytes(b"|"), _bytes(b"!?")
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def repeated(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur more than once."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    flags = np.zeros(len(keys), bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return flags


def _distinct(owners: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each text has."""
    keys = S.mix(hashes ^ S.mix(owners.astype(np.uint64)))
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return np.bincount(owners[order[first]], minlength=n)


def _count(chunk: S.Chunk) -> dict[str, np.ndarray]:
    data, n = chunk.data, chunk.n
    sums = S.running_hash(data)
    starts, ends, owners = chunk.runs(S.WORD_BYTE)
    hashes = S.hash_between(sums, starts, ends)
    points = (data & 0xC0) != 0x80
    in_words = S.WORD_BYTE[data]
    line_starts, line_ends, line_owners = chunk.lines()
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_words, out=before[1:])
    worded = before[line_ends] > before[line_starts]
    line_starts, line_ends, line_owners = (x[worded] for x in (line_starts, line_ends, line_owners))
    line_hashes = S.hash_between(sums, line_starts, line_ends)
    n_lines = np.bincount(line_owners, minlength=n)
    three, at = S.grams(hashes, owners, 3)
    twice = at[repeated(S.mix(three ^ S.mix(owners[at].astype(np.uint64))))]
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[twice + k] = True
    return {
        "n_words": np.bincount(owners, minlength=n),
        "word_chars": chunk.totals(points & in_words),
        "n_symbols": chunk.totals(_SYMBOLS[data]),
        "n_dup_lines": n_lines - _distinct(line_owners, line_hashes, n),
        "n_repeat_words": np.bincount(owners[covered], minlength=n),
        "n_lines": n_lines,
        "n_upper": chunk.totals(_UPPER[data]),
        "n_bars": chunk.totals(_BARS[data]),
        "n_marks": chunk.totals(_MARKS[data]),
        "n_letters": chunk.totals(_letter[data] & points),
        "n_distinct": _distinct(owners, hashes, n),
        "n_chars": chunk.totals(points),
    }


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts ``COUNTS`` and ``MORE`` of each text."""
    parts = [_count(chunk) for chunk in S.chunks(texts)]
    empty = np.zeros(0, np.int64)
    return {k: np.concatenate([empty, *(p[k] for p in parts)]) for k in (*COUNTS, *MORE)}


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    c = {k: v.astype(np.float64) for k, v in counts.items()}
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    letters, chars = np.maximum(c["n_letters"], 1), np.maximum(c["n_chars"], 1)
    return np.column_stack(
        [
            c["n_symbols"] / words,
            c["n_bars"] / words,
            c["n_marks"] / words,
            c["n_repeat_words"] / words,
            c["n_dup_lines"] / lines,
            c["n_upper"] / letters,
            c["word_chars"] / words,
            c["n_letters"] / chars,
            c["n_words"] / lines,
            c["n_distinct"] / words,
        ]
    )


@dataclass
class Forest:
    """Complete trees of one depth as flat arrays: node i has the children 2i + 1 and 2i + 2."""

    depth: int
    base: float
    feature: list = field(default_factory=list)  # per tree: feature of each inner node
    cut: list = field(default_factory=list)  # per tree: values above it go right
    value: list = field(default_factory=list)  # per tree: what each leaf adds

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), 2**self.depth - 1
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - inner]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    direction: list[int],
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    ridge: float = 5.0,
) -> Forest:
    """Boosted trees on the logistic loss; where ``direction`` is 1 or -1 the score only rises or falls.

    A split against a feature's direction is not made, and both children keep within the mean of their
    values on that side, so that no later split can undo it.
    """
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    forest = Forest(depth, float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return forest
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(k, c) for k, c in zip(cuts, x.T, strict=True)])
    margin = np.full(len(y), forest.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        low, high = np.full(2 ** (depth + 1) - 1, -np.inf), np.full(2 ** (depth + 1) - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for i in range(2**depth - 1):
            low[2 * i + 1 : 2 * i + 3], high[2 * i + 1 : 2 * i + 3] = low[i], high[i]
            here = np.flatnonzero(node == i)
            best = 1e-6
            for f, edges in enumerate(cuts):
                gs = np.cumsum(np.bincount(binned[here, f], g[here], len(edges) + 1))
                hs = np.cumsum(np.bincount(binned[here, f], h[here], len(edges) + 1))
                gl, hl, gr, hr = gs[:-1], hs[:-1], gs[-1] - gs[:-1], hs[-1] - hs[:-1]
                left = np.clip(gl / (hl + ridge), low[i], high[i])
                right = np.clip(gr / (hr + ridge), low[i], high[i])
                gain = gl * left + gr * right - ((hl + ridge) * left**2 + (hr + ridge) * right**2) / 2
                whole = np.clip(gs[-1] / (hs[-1] + ridge), low[i], high[i])
                gain -= gs[-1] * whole - (hs[-1] + ridge) * whole**2 / 2
                gain[(hl < 1) | (hr < 1) | (direction[f] * (right - left) < 0)] = 0
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best:
                    best, feature[i], cut[i], middle = gain[k], f, edges[k], (left[k] + right[k]) / 2
                    split = (f, k, direction[f], middle)
            if np.isfinite(cut[i]):
                f, k, way, middle = split
                goes = binned[here, f] > k
                node[here] = 2 * i + 1 + goes
                if way:
                    lower, upper = (2 * i + 1, 2 * i + 2) if way > 0 else (2 * i + 2, 2 * i + 1)
                    high[lower], low[upper] = middle, middle
            else:
                node[here] = 2 * i + 1
        leaf = node - (2**depth - 1)
        gs = np.bincount(leaf, g, 2**depth)
        hs = np.bincount(leaf, h, 2**depth)
        first = 2**depth - 1
        value = rate * np.clip(gs / (hs + ridge), low[first:], high[first:])
        margin += value[leaf]
        forest.feature.append(feature)
        forest.cut.append(cut)
        forest.value.append(value)
    return forest


def train(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> Forest:
    """Trees from the statistics of at most ``bound`` labelled documents."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = features(count_texts(batch.column("text")))
        values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), values.cast(pa.list_(pa.float64()))],
            ["doc_id", "label", "x"],
        )

    sample = labelled_sample(documents, labels, "quality", bound)
    rows = sample.mapInArrow(by_batch(count), "doc_id bigint, label int, x array<double>").toPandas()
    rows = rows.sort_values("doc_id")
    x = np.array(rows["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, rows["label"].to_numpy(np.float64), [way for _, way in FEATURES])


def judge(documents: DataFrame, forest: Forest, columns: list[str] | None = None) -> DataFrame:
    """The named columns of each row with the counts of its text, base_failed, quality and kept."""
    columns = ["doc_id"] if columns is None else columns
    taken = documents.select(*columns, F.col("text").alias("_text"))

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = count_texts(batch.column("_text"))
        quality = forest.probability(features(counts))
        words = counts["n_words"]
        failed = (words < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PCT * words)
        made = {c: batch.column(c) for c in columns}
        made |= {c: pa.array(counts[c].astype(np.int64)) for c in COUNTS}
        made |= {
            "base_failed": pa.array(failed),
            "quality": pa.array(quality),
            "kept": pa.array(~failed & (quality >= REJECT_BELOW)),
        }
        return pa.RecordBatch.from_pydict(made)

    schema = ", ".join(
        [
            *(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns),
            *(f"{c} bigint" for c in COUNTS),
            "base_failed boolean, quality double, kept boolean",
        ]
    )
    return taken.mapInArrow(by_batch(score), schema)


def keep_good(documents: DataFrame, forest: Forest) -> DataFrame:
    """The documents that the base rules and the trees keep, with all their columns."""
    names = [f"_c{i}" for i in range(len(documents.columns))]
    text = names[documents.columns.index("text")]
    renamed = documents.toDF(*names).withColumn("text", F.col(text))
    return judge(renamed, forest, names).where("kept").select(*names).toDF(*documents.columns)
