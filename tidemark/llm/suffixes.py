"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are classed as smaller (S) or larger (L) than the suffix after them. The leftmost S suffixes of
each run are sorted by the stretch up to the next one: once by inducing, and where stretches are equal by
sorting the string of their names the same way. All other suffixes follow by two passes over the buckets of
first symbols. With few symbols, a pass takes a bucket's suffixes at once; with many, one by one.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm import spans as S

FEW_SYMBOLS = 1024


def _classes(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last, empty of followers, is."""
    n = len(s)
    rises = np.sign(np.diff(s.astype(np.int64)))
    decided = np.where(rises != 0, np.arange(n - 1), n - 1)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    return np.append(np.append(rises, 1)[decided] > 0, True)


def _group(symbols: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by symbol that keeps equal ones in place, their places within symbols, and the counts."""
    order = np.argsort(symbols, kind="stable")
    counts = np.bincount(symbols, minlength=bins)
    within = np.arange(len(symbols)) - (np.cumsum(counts) - counts)[symbols[order]]
    return order, within, counts


def _induce_by_bucket(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, bins: int) -> np.ndarray:
    n = len(s)
    counts = np.bincount(s, minlength=bins)
    end = np.cumsum(counts)
    start = end - counts
    sa = np.full(n, -1, np.int64)
    order, within, seeded = _group(s[seeds], bins)
    lowest = end - seeded
    own = seeds[order]
    sa[lowest[s[own]] + within] = own
    head = start.copy()
    s, narrow = s, s.astype(np.uint16)

    def push_right(batch: np.ndarray) -> None:
        p = batch[batch > 0] - 1
        p = p[~smaller[p]]
        if len(p):
            order, within, added = _group(narrow[p], bins)
            p = p[order]
            sa[head[s[p]] + within] = p
            np.add(head, added, out=head)

    for c in np.flatnonzero(counts):
        at = start[c]
        while at < head[c]:
            upto = head[c]
            push_right(sa[at:upto].copy())
            at = upto
        if seeded[c]:
            push_right(sa[lowest[c] : end[c]].copy())
    tail = end.copy()

    def push_left(batch: np.ndarray) -> None:
        p = batch[batch > 0] - 1
        p = p[smaller[p]]
        if len(p):
            order, within, added = _group(narrow[p], bins)
            p = p[order]
            sa[tail[s[p]] - 1 - within] = p
            np.subtract(tail, added, out=tail)

    for c in np.flatnonzero(counts)[::-1]:
        at = end[c]
        while at > tail[c]:
            upto = tail[c]
            push_left(sa[upto:at][::-1].copy())
            at = upto
        if head[c] > start[c]:
            push_left(sa[start[c] : head[c]][::-1].copy())
    sa[0] = n - 1
    return sa


def _induce_one_by_one(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, bins: int) -> np.ndarray:
    n = len(s)
    counts = np.bincount(s, minlength=bins)
    end = np.cumsum(counts)
    head, tail = (end - counts).tolist(), end.tolist()
    order, within, seeded = _group(s[seeds], bins)
    own = seeds[order]
    placed = np.full(n, -1, np.int64)
    placed[(end - seeded)[s[own]] + within] = own
    sa, symbol, small = placed.tolist(), s.tolist(), smaller.tolist()
    for i in range(n):
        p = sa[i] - 1
        if p >= 0 and not small[p]:
            c = symbol[p]
            sa[head[c]] = p
            head[c] += 1
    for i in range(n - 1, -1, -1):
        p = sa[i] - 1
        if p >= 0 and small[p]:
            c = symbol[p]
            tail[c] -= 1
            sa[tail[c]] = p
    sa[0] = n - 1
    return np.array(sa, np.int64)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Beginnings of all suffixes in order. The last symbol must be 0 and occur nowhere else."""
    n = len(s)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    bins = int(s.max()) + 1
    induce = _induce_by_bucket if bins <= FEW_SYMBOLS else _induce_one_by_one
    smaller = _classes(s)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(leftmost) <= 1:
        return induce(s, smaller, leftmost, bins)
    sa = induce(s, smaller, leftmost, bins)
    chosen = np.zeros(n, bool)
    chosen[leftmost] = True
    ordered = sa[chosen[sa]]
    stretch_end = np.append(leftmost[1:] + 1, n)  # up to and with the beginning of the next one
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(S.mix(s.astype(np.uint64) + np.uint64(1)) * S.powers(n)[0], out=sums[1:])
    hashes = S.hash_between(sums, leftmost, stretch_end)
    number = np.empty(n, np.int64)
    number[leftmost] = np.arange(len(leftmost))
    in_order = hashes[number[ordered]]
    names = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])])
    if names[-1] + 1 < len(leftmost):
        reduced = np.empty(len(leftmost), np.int64)
        reduced[number[ordered]] = names
        ordered = leftmost[suffix_array(reduced)]
        return induce(s, smaller, ordered, bins)
    return induce(s, smaller, ordered, bins)


def permuted_common_prefixes(
    s: np.ndarray, sa: np.ndarray, restart: np.ndarray, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the suffix before it in the array (-1 for the first) and their common prefix.

    Where the symbols before both are equal, the common prefix is one less than that of the place before;
    only the other places are compared symbol by symbol, and those in ``restart``. Prefixes count up to
    ``most``; the distance between restarts must leave what is asked for.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    follows = np.zeros(n, bool)
    at = np.flatnonzero((before > 0) & (np.arange(n) > 0))
    follows[at] = s[at - 1] == s[before[at] - 1]
    follows &= np.concatenate([[False], before[1:] == before[:-1] + 1])
    follows[restart] = False
    lead = np.flatnonzero(~follows)
    common = np.zeros(n, np.int64)
    open_ = lead[before[lead] >= 0]
    for step in range(most):
        open_ = open_[(open_ + step < n) & (before[open_] + step < n)]
        open_ = open_[s[open_ + step] == s[before[open_] + step]]
        if not len(open_):
            break
        common[open_] = step + 1
    last = np.maximum.accumulate(np.where(follows, 0, np.arange(n)))
    return before, np.maximum(common[last] - (np.arange(n) - last), 0)
