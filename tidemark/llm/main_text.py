"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A block's score for belonging to the article is the sum of the weights of its features: the tags and the
words of class, id and role among its ancestors, its own and its nearest named ancestor, and its
length, links, punctuation and place. Neighbouring blocks are joined by transition weights, one set for
blocks of the same parent path and one for others. Training maximises the likelihood of labelled pages by
forward-backward sums over all pages at once; decoding takes the best sequence (Viterbi).

The field is trained on ``PAGES`` labelled pages of ``labelled_pages``, a fixed bound.

Defined results: a null or empty page, or one without article blocks, has the empty text; scripts, styles,
comments of the markup and the head never give text; repeated rows are extracted each; any columns of the
input besides page_id, url and html are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.html_blocks import Block, blocks
from tidemark.llm.labelled_pages import labelled_page
from tidemark.llm.rows import tidy

PAGES = 1000


def text_features(block: Block, place: int, n: int) -> list[str]:
    """What the text and the place of a block tell."""
    text = block.text
    size = len(text)
    words = text.count(" ") + 1
    share = block.linked / size
    found = [
        f"words={min(6, int(words).bit_length())}",
        f"links={0 if share == 0 else 1 if share < 0.4 else 2 if share < 0.8 else 3}",
        "end" if text[-1] in ".!?…:;\"'”»)" else "noend",
        "tail=first" if place == 0 else "tail=last" if place == n - 1 else "tail=inner",
    ]
    if "©" in text or "copyright" in text[:40].lower():
        found.append("rights")
    return found


def path_features(block: Block) -> list[str]:
    path = block.path
    return ["bias", f"own={path.tag}", *path.names, *(f"near {x}" for x in path.nearest)]


@dataclass
class Field:
    """Weights for label 1 by feature, and transition weights by kind (same path or not) and labels."""

    weight: dict[str, float]
    transition: np.ndarray

    def label(self, page: list[Block], cache: dict) -> list[bool]:
        """The best labels of a page's blocks."""
        weight, n = self.weight, len(page)
        score: list[float] = []
        for i, block in enumerate(page):
            if block.path not in cache:
                cache[block.path] = sum(weight.get(f, 0.0) for f in path_features(block))
            score.append(cache[block.path] + sum(weight.get(f, 0.0) for f in text_features(block, i, n)))
        moves = self.transition.tolist()
        best = [0.0, score[0]]
        back: list[tuple[int, int]] = []
        for i in range(1, n):
            move = moves[page[i].path is page[i - 1].path]
            to0 = (best[0] + move[0][0], best[1] + move[1][0])
            to1 = (best[0] + move[0][1], best[1] + move[1][1])
            back.append((int(to0[1] > to0[0]), int(to1[1] > to1[0])))
            best = [max(to0), max(to1) + score[i]]
        label = int(best[1] > best[0])
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return [bool(x) for x in reversed(labels)]


def posterior(
    node: np.ndarray, t: np.ndarray, kind: np.ndarray, first: np.ndarray, size: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Chance of label 1 of each block, and of each pair of labels of the blocks that are not first on a page.

    ``node`` has the scores of a block's labels, ``t`` those of moves by kind; pages begin at ``first``.
    """
    place = np.arange(len(node)) - np.repeat(first, size)
    inner = np.flatnonzero(place > 0)
    steps = [first[size > k] + k for k in range(int(size.max()))]  # the k-th blocks of the pages that have one
    ahead, behind = node.copy(), np.zeros_like(node)
    for at in steps[1:]:
        ahead[at] += np.logaddexp.reduce(ahead[at - 1][:, :, None] + t[kind[at]], axis=1)
    for at in reversed(steps[1:]):
        behind[at - 1] = np.logaddexp.reduce(t[kind[at]] + (node[at] + behind[at])[:, None, :], axis=2)
    whole = np.repeat(np.logaddexp.reduce(ahead[first + size - 1], axis=1), size)
    chance = np.exp(ahead[:, 1] + behind[:, 1] - whole)
    pair = np.exp(
        ahead[inner - 1][:, :, None] + t[kind[inner]] + (node[inner] + behind[inner])[:, None, :]
        - whole[inner][:, None, None]
    )
    return chance, pair


def train(n_pages: int = PAGES, rounds: int = 150, rate: float = 0.5, ridge: float = 0.1) -> Field:
    """A field from the first ``n_pages`` labelled pages."""
    number: dict[str, int] = {}
    rows, columns, labels, same, sizes = [], [], [], [], []
    for seed in range(n_pages):
        page, wanted = labelled_page(seed)
        found = blocks(page)
        if len(found) != len(wanted):
            raise ValueError(f"labels of page {seed} do not match its blocks")
        for i, block in enumerate(found):
            features = path_features(block) + text_features(block, i, len(found))
            row = len(labels)
            columns += [number.setdefault(f, len(number)) for f in features]
            rows += [row] * len(features)
            labels.append(wanted[i])
            same.append(i > 0 and found[i - 1].path is block.path)
        sizes.append(len(found))
    row, column = np.array(rows), np.array(columns)
    y, kind, size = np.array(labels), np.array(same, np.int64), np.array(sizes)
    first = np.cumsum(size) - size
    w, t = np.zeros(len(number)), np.zeros((2, 2, 2))
    seen_w, seen_t = np.full(len(number), 1e-3), np.full((2, 2, 2), 1e-3)
    place = np.arange(len(y)) - np.repeat(first, size)
    inner = np.flatnonzero(place > 0)
    gold_w = np.bincount(column, y[row].astype(float), len(number))
    gold_t = np.zeros((2, 2, 2))
    np.add.at(gold_t, (kind[inner], y[inner - 1], y[inner]), 1.0)
    for _ in range(rounds):
        node = np.zeros((len(y), 2))
        node[:, 1] = np.bincount(row, w[column], len(y))
        chance, pair = posterior(node, t, kind, first, size)
        grad_w = gold_w - np.bincount(column, chance[row], len(number)) - ridge * w
        grad_t = gold_t - ridge * t
        np.subtract.at(grad_t, kind[inner], pair)
        seen_w += grad_w**2
        seen_t += grad_t**2
        w += rate * grad_w / np.sqrt(seen_w)
        t += rate * grad_t / np.sqrt(seen_t)
    return Field({f: float(w[i]) for f, i in number.items()}, t)


def extract_page(page: str, field: Field, cache: dict) -> str:
    found = blocks(page)
    if not found:
        return ""
    labels = field.label(found, cache)
    return "\n\n".join(b.text for b, kept in zip(found, labels, strict=True) if kept)


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """page_id, url, text and n_chars of each whole page."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cache: dict = {}
            texts = [extract_page(h, field, cache) if h else "" for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
