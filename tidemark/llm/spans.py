"""Words, lines and their hashes, found on the UTF-8 bytes of many texts at once.

A batch of texts is cut into chunks of about ``CHUNK_BYTES``; each chunk is one array of bytes and the
offsets of its texts, so that the work per text is a few array operations whatever its length. Hashes
are polynomials over the bytes modulo 2**64, read off one running sum, and mixed afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
WORD_BYTE = ~_space  # bytes outside white space
LETTER_BYTE = np.zeros(256, bool)  # letters and digits; every byte of a character beyond ASCII
LETTER_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values over the whole word; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_value = mix(np.arange(1, 257, dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + (1 << 16))
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers[:n], _inverses[:n]


def running_hash(data: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    """Sums from which ``hash_between`` reads the hash of any stretch of the bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_value[fold][data] * powers(len(data))[0], out=sums[1:])
    return sums


def hash_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end), equal for equal bytes."""
    inverse = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Chunk:
    """Texts ``first`` to ``first + n - 1`` of a batch; text i is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def totals(self, flags: np.ndarray) -> np.ndarray:
        """How many of the flagged bytes each text has."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest runs of member bytes that do not leave their text: starts, ends, text numbers."""
        inside = member[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = self.offsets[1:] > self.offsets[:-1]
        heads, tails = self.offsets[:-1][filled], self.offsets[1:][filled] - 1
        first[heads] = inside[heads]
        last[tails] = inside[tails]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, self.owner(starts)

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """Numbers of the texts that hold these bytes."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lines of the texts that are not empty: starts, ends without the newline, text numbers."""
        breaks = np.flatnonzero(self.data == 10)
        filled = self.offsets[1:] > self.offsets[:-1]
        starts = np.sort(np.concatenate([self.offsets[:-1][filled], breaks + 1]))
        owners = np.sort(np.concatenate([np.flatnonzero(filled), self.owner(breaks)]))
        ends = np.sort(np.concatenate([self.offsets[1:][filled], breaks]))
        return starts, ends, owners


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one array of texts with 64-bit offsets; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a column, some at a time; a text longer than ``size`` is a chunk by itself."""
    column = text_array(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(max(end, at + 1), len(column))
        lo, hi = offsets[at], offsets[end]
        yield Chunk(at, data[lo:hi], offsets[at : end + 1] - lo)
        at = end


def grams(hashes: np.ndarray, owners: np.ndarray, n: int, gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n neighbouring words, ``gap`` words apart, within a text; and their first word's number."""
    step = gap + 1
    reach = (n - 1) * step
    if len(hashes) <= reach:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = len(hashes) - reach
    joined = hashes[:last].copy()
    for k in range(1, n):
        joined = mix(joined * np.uint64(0x9DDFEA08EB382D69) + hashes[k * step : k * step + last])
    at = np.flatnonzero(owners[:last] == owners[reach:])
    return joined[at] + np.uint64(1000 * gap + n), at
