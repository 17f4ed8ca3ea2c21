"""Token ids in Arrow files of fixed-size lists, with random access to sequences of equal length.

Texts are encoded by a byte-level BPE tokenizer, an end id is appended to each, and the ids are written in
order of doc_id, one file for each part of the order. A file holds record batches of ``BATCH_ROWS`` rows; a
row has ``SEQUENCE`` ids and a mask that is false where the last row is padded. A second file lists the
documents with the place of their ids. ``TokenFile`` maps both into memory and reads without copying.

Encoding cuts a text where the tokenizer's own splitting cuts it anyway (around white space, before
punctuation), and encodes each different piece once; texts that hold white space beyond ASCII or one of the
tokenizer's added tokens go to the tokenizer whole. Ids are always those that the tokenizer gives the whole text.

A task that is repeated writes files of other names; only those of the attempt that counted are listed.

Defined results: a null or empty text has the end id alone; repeated rows are encoded each; rows of one id
are ordered by their ids, null ids come last; an empty table writes no file and gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans as S
from tidemark.llm.order import in_order
from tidemark.llm.rows import shared_folder, tidy

SEQUENCE = 2048
BATCH_ROWS = 64
END_ID = 0
CACHE_PIECES = 1_000_000  # different pieces whose ids a worker remembers, at most
_CHUNK_BYTES = 4 << 20

_alnum = np.zeros(256, bool)
_alnum[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_punctuation = np.zeros(256, bool)
_punctuation[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def wide_space(chunk: S.Chunk) -> np.ndarray:
    """Flags of the texts that hold white space beyond ASCII."""
    d = np.concatenate([chunk.data, np.zeros(2, np.uint8)])
    a, b, c = d[:-2], d[1:-1], d[2:]
    found = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    found |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    general = (c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)
    found |= (a == 0xE2) & (b == 0x80) & (c >= 0x80) & general
    found |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    found |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    flags = np.zeros(chunk.n, bool)
    flags[chunk.owner(np.flatnonzero(found))] = True
    return flags


def piece_starts(chunk: S.Chunk) -> np.ndarray:
    """Where the pieces begin that can be encoded apart."""
    data = chunk.data
    space = ~S.WORD_BYTE[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[1:-1] |= space[1:] & ~space[:-1]
    into_word = np.flatnonzero(~space[1:] & space[:-1]) + 1
    begins[into_word - 1] = True  # the last white space goes with the word if it is a blank
    begins[into_word[data[into_word - 1] != 0x20]] = True
    begins[1:-1] |= _punctuation[data[1:]] & _alnum[data[:-1]]
    filled = chunk.offsets[1:] > chunk.offsets[:-1]
    heads = chunk.offsets[:-1][filled]
    # across the end of a text, what follows does not count
    ends = chunk.offsets[1:][filled] - 1
    alone = np.flatnonzero(space[ends])
    before = ends[alone] - 1
    begins[ends[alone][(before >= 0) & space[before]]] = False
    begins[heads] = True
    single = ends[alone][np.isin(ends[alone], heads)]
    begins[single] = True
    return np.flatnonzero(begins[:-1])


class Encoder:
    """A tokenizer that remembers the ids of pieces it has seen."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in added if t.content]
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    def whole_texts(self, chunk: S.Chunk) -> np.ndarray:
        """Numbers of the texts that cannot be cut into pieces."""
        flags, data = wide_space(chunk), chunk.data.tobytes()
        for token in self.added:
            at = data.find(token)
            while at >= 0:
                own = int(chunk.owner(np.array([at]))[0])
                flags[own] = True
                # a text is looked at once; what crosses its end is looked at again with the next one
                at = data.find(token, max(at + 1, int(chunk.offsets[own + 1]) - len(token) + 1))
        return np.flatnonzero(flags)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), self.dtype, int(counts.sum())), counts

    def _learn(self, chunk: S.Chunk, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inner = at < len(self.keys)
        known[inner] = self.keys[at[inner]] == keys[inner]
        new = np.flatnonzero(~known)
        if not len(new):
            return
        data = chunk.data.tobytes()
        texts = [data[a:b].decode() for a, b in zip(starts[new], ends[new], strict=True)]
        ids, counts = self._encode(texts)
        begin = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate([self.ids, ids])
        self.keys = np.insert(self.keys, at[new], keys[new])
        self.begin = np.insert(self.begin, at[new], begin)
        self.count = np.insert(self.count, at[new], counts)

    def encode_chunk(self, chunk: S.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of the chunk, and how many each text has."""
        if len(self.keys) > CACHE_PIECES:
            self.forget()
        starts = piece_starts(chunk)
        ends = np.append(starts[1:], len(chunk.data))[: len(starts)]
        owners = chunk.owner(starts)
        hashes = S.hash_between(S.running_hash(chunk.data), starts, ends)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        self._learn(chunk, keys, starts[first], ends[first])
        at = np.searchsorted(self.keys, keys)
        begin, count = self.begin[at][inverse], self.count[at][inverse]
        after = np.cumsum(count)
        ids = self.ids[np.repeat(begin - after + count, count) + np.arange(after[-1] if len(after) else 0)]
        counts = np.bincount(owners, count, chunk.n).astype(np.int64)
        odd = self.whole_texts(chunk)
        if len(odd):
            own = np.split(ids, np.cumsum(counts)[:-1])
            for i in odd:
                text = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes().decode()
                own[i], counts[i : i + 1] = self._encode([text])
            ids = np.concatenate(own)
        return ids, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, an end id after each text's own, and where each text's ids end."""
        all_ids, all_counts = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for chunk in S.chunks(texts, _CHUNK_BYTES):
            ids, counts = self.encode_chunk(chunk)
            all_ids.append(np.insert(ids, np.cumsum(counts), END_ID))
            all_counts.append(counts + 1)
        return np.concatenate(all_ids), np.cumsum(np.concatenate(all_counts))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder given as a path or a URI."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    scheme, _, rest = uri.partition(":")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)  # names that only Hadoop knows
    return pafs.FileSystem.from_uri(f"{scheme}:{rest if rest.startswith('//') else '//' + rest}")


class Writer:
    """Writes one part: a file of sequences and a file of documents.

    Their names are new each time, so that attempts of a repeated task do not touch each other's files;
    whoever lists the parts names those of the attempt that ended.
    """

    def __init__(self, folder: str, part: int, dtype: np.dtype) -> None:
        self.fs, self.root = open_folder(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.name = f"part-{part:08d}-{uuid.uuid4().hex}"
        self.path = f"{self.root}/{self.name}"
        self.kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema(
            [("ids", pa.list_(self.kind, SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))]
        )
        self.sink = self.fs.open_output_stream(f"{self.path}.arrow")
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.documents: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id, self.n_ids, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= SEQUENCE * BATCH_ROWS:
            self._write(last=False)

    def _write(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint16)
        step = SEQUENCE * BATCH_ROWS
        whole = len(ids) if last else len(ids) // step * step
        for at in range(0, whole, step):
            own = ids[at : min(at + step, whole)]
            rows = -(-len(own) // SEQUENCE)
            padded = np.zeros(rows * SEQUENCE, own.dtype)
            padded[: len(own)] = own
            mask = pa.array(np.arange(rows * SEQUENCE) < len(own))
            self.file.write_batch(
                pa.RecordBatch.from_arrays(
                    [
                        pa.FixedSizeListArray.from_arrays(pa.array(padded, self.kind), SEQUENCE),
                        pa.FixedSizeListArray.from_arrays(mask, SEQUENCE),
                    ],
                    schema=self.schema,
                )
            )
        self.held = [ids[whole:]]
        self.n_held = len(ids) - whole

    def close(self) -> tuple[str, int]:
        self._write(last=True)
        self.file.close()
        self.sink.close()
        columns = list(zip(*self.documents, strict=True))
        listed = pa.table(
            [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens"]
        )
        with self.fs.open_output_stream(f"{self.path}.docs.arrow") as sink:
            with pa.ipc.new_file(sink, listed.schema) as file:
                file.write_table(listed)
        return self.name, self.n_ids


class TokenFile:
    """A written part, mapped into memory."""

    def __init__(self, folder: str, name: str) -> None:
        fs, root = open_folder(folder)
        if isinstance(fs, pafs.LocalFileSystem):
            sources = [pa.memory_map(f"{root}/{name}.{kind}") for kind in ("arrow", "docs.arrow")]
        else:
            sources = [fs.open_input_file(f"{root}/{name}.{kind}") for kind in ("arrow", "docs.arrow")]
        self.file = pa.ipc.open_file(sources[0])
        self.documents = pa.ipc.open_file(sources[1]).read_all()
        self.last: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint16))

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence i, without copying."""
        batch = self.file.get_batch(i // BATCH_ROWS)
        row = i % BATCH_ROWS
        ids = batch.column(0).flatten()[row * SEQUENCE : (row + 1) * SEQUENCE]
        mask = batch.column(1).flatten()[row * SEQUENCE : (row + 1) * SEQUENCE]
        return ids.to_numpy(zero_copy_only=True), mask

    def _batch(self, i: int) -> np.ndarray:
        if self.last[0] != i:
            self.last = (i, self.file.get_batch(i).column(0).flatten().to_numpy(zero_copy_only=True))
        return self.last[1]

    def ids(self, start: int, n: int) -> np.ndarray:
        """The n ids from place ``start`` of the part."""
        step, found = SEQUENCE * BATCH_ROWS, []
        while n > 0:
            batch, at = divmod(start, step)
            found.append(self._batch(batch)[at : at + n])
            start, n = start + len(found[-1]), n - len(found[-1])
        return found[0] if len(found) == 1 else np.concatenate(found)


def write(documents: DataFrame, tokenizer: str, folder: str) -> list[tuple[str, int]]:
    """Write all texts; names of the parts in order of ids, each with the number of ids before it.

    ``folder`` is a path on a file system that all workers share, as ``shared_folder`` gives it, with its scheme.
    """

    def encode(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        ids, ends = encoder(tokenizer).encode(batch.column("text"))
        offsets = np.concatenate([[0], ends]).astype(np.int64) * ids.itemsize
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
        )
        return {"ids": found.cast(pa.binary())}

    @tidy
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(tokenizer).dtype
        writer, part, done = None, None, []
        for batch in batches:
            for own, doc_id, ids in zip(
                batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(),
                batch.column("ids"), strict=True,
            ):
                if own != part:
                    if writer:
                        done.append((part, *writer.close()))
                    writer, part = Writer(folder, own, dtype), own
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), dtype))
        if writer:
            done.append((part, *writer.close()))
        columns = list(zip(*done, strict=True)) if done else [[], [], []]
        kinds = (pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "name", "n_ids"]
        )

    taken = documents.select("doc_id", "text")
    dealt = in_order(taken, encode, "ids binary", "ids")
    parts = dealt.mapInArrow(put, "part bigint, name string, n_ids bigint").collect()
    listed, before = [], 0
    for row in sorted(parts, key=lambda r: r["part"]):
        listed.append((row["name"], before))
        before += row["n_ids"]
    return listed


def read_back(spark, folder: str, parts: list[tuple[str, int]]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, read from the files."""

    @tidy
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(
                batch.column("name").to_pylist(), batch.column("before").to_pylist(), strict=True
            ):
                file = TokenFile(folder, name)
                starts = file.documents["start"].to_numpy()
                counts = file.documents["n_tokens"].to_numpy()
                sums = [
                    zlib.crc32(file.ids(int(a), int(n)).astype("<u4").tobytes())
                    for a, n in zip(starts, counts, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        file.documents["doc_id"].combine_chunks(), pa.array(starts + before),
                        pa.array(counts), pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    listed = spark.createDataFrame(parts, "name string, before bigint").repartition(max(1, len(parts)))
    return listed.mapInArrow(check, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Write the ids of all documents to a new shared folder, and list them as read from there."""
    folder = shared_folder(documents.sparkSession)
    parts = write(documents.withColumn("text", F.coalesce("text", F.lit(""))), tokenizer, folder)
    return read_back(documents.sparkSession, folder, parts)
