"""Document fingerprints: a digest of the quartiles of hashed byte triplets.

The triplets of bytes within a sliding window are hashed to ``BUCKETS`` counters. The digest holds, in hex,
a logarithmic code of the length, the ratios of the quartiles of the counters, and for each
counter in which quarter it lies. Digests compare by a bounded difference: of the length codes, of the
ratios and of the quarters, where opposite quarters weigh most; ``likeness`` turns it into 0 to 1.

Defined results: null counts as the empty text, whose digest is all zeros; equal texts have equal digests;
rows are ordered by descending doc_id, null ids last, and by text where ids are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.order import in_order
from tidemark.llm.rows import tidy

BUCKETS = 256
#: Which bytes of a window make a triplet, as distances from its first byte.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 2, 4))
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
MAX_LENGTH_GAP, MAX_RATIO_GAP = 24, 7
_QUARTER_GAP = np.array([0, 1, 2, 6])
MOST = 2 * MAX_LENGTH_GAP + 2 * 2 * MAX_RATIO_GAP + 6 * BUCKETS


def count_triplets(data: np.ndarray) -> np.ndarray:
    """How many triplets fall into each bucket."""
    wide = data.astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    for k, triplet in enumerate(TRIPLETS):
        n = len(wide) - triplet[-1]
        if n <= 0:
            continue
        mixed = np.full(n, np.uint32(k * 0x27D4EB2F & 0xFFFFFFFF))
        for at, factor in zip(triplet, _FACTORS, strict=True):
            mixed = (mixed ^ wide[at : at + n]) * np.uint32(factor)
        counts += np.bincount((mixed >> np.uint32(24)).astype(np.uint8), minlength=BUCKETS)
    return counts


def digest(text: bytes | pa.Buffer) -> str:
    """The fingerprint of a text, given as UTF-8."""
    data = np.frombuffer(text, np.uint8)
    counts = count_triplets(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quarters = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    code = min(255, int(np.log2(len(data)) * 8) + 1) if len(data) else 0
    ratios = (int(q1 * 15 // q3) << 4 | int(q2 * 15 // q3)) if q3 else 0
    four = quarters.reshape(-1, 4)
    packed = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return bytes([code, ratios]).hex() + packed.astype(np.uint8).tobytes().hex()


def difference(one: str, other: str) -> int:
    """0 for equal fingerprints, ``MOST`` at most."""
    a, b = (np.frombuffer(bytes.fromhex(x), np.uint8) for x in (one, other))
    length = min(abs(int(a[0]) - int(b[0])), MAX_LENGTH_GAP)
    high = min(abs(int(a[1] >> 4) - int(b[1] >> 4)), MAX_RATIO_GAP)
    low = min(abs(int(a[1] & 15) - int(b[1] & 15)), MAX_RATIO_GAP)
    quarters = [np.stack([x[2:] >> s & 3 for s in (6, 4, 2, 0)]).astype(np.int64) for x in (a, b)]
    return 2 * length + 2 * (high + low) + int(_QUARTER_GAP[np.abs(quarters[0] - quarters[1])].sum())


def likeness(one: str, other: str) -> float:
    return 1 - difference(one, other) / MOST


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the first characters of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprint(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            made = [digest((t or "").encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.string())], ["doc_id", "fingerprint"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint string")


def compare_edited(documents: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next text's are.

    The next document is the one that follows in descending order of ids; the first follows the last.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def prints(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = batch.column("text")
        return {"text": texts, "own": pa.array([digest(t.as_buffer()) for t in texts], pa.string())}

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # part, id, text and fingerprint of the row whose next one is awaited
        for batch in batches:
            out = []
            columns = ("part", "lent", "doc_id", "text", "own")
            for part, lent, doc_id, text, own in zip(
                *(batch.column(c).to_pylist() for c in columns), strict=True
            ):
                if held and held[0] == part:
                    _, last_id, last_text, last_print = held
                    changed = edited(last_text, text).encode()
                    changed_print = digest(changed)
                    out.append(
                        (
                            last_id, len(last_text), hashlib.sha256(changed).hexdigest(), last_print,
                            changed_print, likeness(last_print, changed_print), likeness(last_print, own),
                        )
                    )
                held = None if lent else (part, doc_id, text, own)
            made = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(made, arrow, strict=True)], schema=arrow
            )

    arrow = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
         ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
         ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )
    spark_schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    dealt = in_order(rows, prints, "text string, own string", "text", descending=True, lend=True)
    return dealt.mapInArrow(run, spark_schema)
