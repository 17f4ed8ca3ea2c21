"""Words of letters and digits, as numbers in a given vocabulary; and query texts, in blocks of bounded size.

A word is a longest run of ASCII letters and digits and of any characters beyond ASCII; only A-Z are lowered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans as S

BLOCK_BYTES = 4 << 20  # text of the queries that are held at a time, about
UNKNOWN = -1


def words_of(chunk: S.Chunk) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray, np.ndarray]:
    """The lowered words of a chunk, with their starts, ends and text numbers."""
    starts, ends, owners = chunk.runs(S.LETTER_BYTE)
    held = S.LOWER[chunk.data[S.LETTER_BYTE[chunk.data]]]
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(held)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers), starts, ends, owners


def numbers(words: pa.Array, vocabulary: pa.Array) -> np.ndarray:
    """Place of each word in the vocabulary; -1 for the others."""
    return pc.index_in(words, value_set=vocabulary).fill_null(UNKNOWN).to_numpy().astype(np.int64)


def vocabulary_of(words: pa.Array) -> pa.Array:
    """The different words, in order."""
    different = words.unique()
    return different.take(pc.array_sort_indices(different))


def blocks(rows: DataFrame, key: str, size: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Key and text of all rows, in tables of about ``size`` bytes of text; rows of one key stay together.

    Rows without a text are left out. Only one table is on the driver at a time; a key of more text than
    that is in a table by itself or with few others.
    """
    rows = rows.select(key, F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // size))
    for k in range(n):
        block = rows.where(F.pmod(F.xxhash64(key), F.lit(n)) == k) if n > 1 else rows
        yield block.toArrow()
