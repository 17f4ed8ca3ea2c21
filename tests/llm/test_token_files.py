import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import order
from tidemark.llm import spans as S
from tidemark.llm import token_files as T
from tidemark.llm.queries import BYTE_BPE, vocabulary_path
from tidemark.llm.rows import shared_folder

PATH = vocabulary_path(BYTE_BPE)
# Pieces that try the tokenizer's splitting.
PIECES = "a|b|it's| |  |\n|\t| \n|é|ß|1|23|.|!!|'s|…| |　|日本|don't|,|\x1c|\x85|'|“|_|​|x'll|<|endoftext".split("|")


def whole(texts):
    """What the library gives the whole texts, unaltered."""
    tokenizer = Tokenizer.from_file(PATH)
    found = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, T.END_ID], "<u4") for e in found]


def test_pieces_give_the_ids_of_whole_texts():
    r = random.Random(5)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 14))) for _ in range(5000)]
    texts += ["", None, "   ", "\n", "a ", " a", "a\n", "<|endoftext|>"]
    encoder = T.Encoder(PATH)
    for _ in range(2):  # the second time from memory
        ids, ends = encoder.encode(pa.array(texts))
        for own, wanted in zip(np.split(ids, ends[:-1]), whole(texts), strict=True):
            assert own.tolist() == wanted.tolist()


def test_added_tokens_are_the_librarys():
    ids, _ = T.Encoder(PATH).encode(pa.array(["hello <|endoftext|> world"]))
    assert 50256 in ids.tolist() or Tokenizer.from_file(PATH).token_to_id("<|endoftext|>") in ids.tolist()
    chunk = next(S.chunks(pa.array(["a<|endof", "text|>b", "<|endoftext|>" * 3, "x", "y<|endoftext|>", "<|endoftext|>"])))
    assert {2, 4, 5} <= set(T.Encoder(PATH).whole_texts(chunk).tolist()) <= {0, 2, 4, 5}


def test_attempts_do_not_touch_each_others_files(tmp_path):
    names = []
    for _ in range(2):
        writer = T.Writer(str(tmp_path), 1, np.dtype(np.uint16))
        writer.add(1, np.arange(5, dtype=np.uint16))
        names.append(writer.close()[0])
    assert len(set(names)) == 2
    assert all(T.TokenFile(str(tmp_path), n).ids(0, 5).tolist() == [0, 1, 2, 3, 4] for n in names)


def test_folders_have_their_scheme(spark):
    assert shared_folder(spark).startswith("file:/")
    assert T.open_folder("file:/a/b")[1] == T.open_folder("file:///a/b")[1] == T.open_folder("/a/b")[1] == "/a/b"


def test_a_forgetful_encoder(monkeypatch):
    monkeypatch.setattr(T, "CACHE_PIECES", 3)
    monkeypatch.setattr(T, "_CHUNK_BYTES", 20)
    texts = ["some words", "and some more words", "", "words again"] * 4
    ids, ends = T.Encoder(PATH).encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [x.tolist() for x in whole(texts)]


def check(frame):
    held = frame.collect()
    rows = sorted(
        ((r["doc_id"], ids) for r, ids in zip(held, whole([r["text"] for r in held]), strict=True)),
        key=lambda r: (r[0] is None, r[0] or 0, r[1].astype(np.uint16).tobytes()),
    )
    wanted, start = [], 0
    for doc_id, ids in rows:
        wanted.append((str(doc_id), start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [(str(r[0]), *r[1:]) for r in T.round_trip(frame, PATH).collect()]
    assert sorted(got) == sorted(wanted)


@pytest.mark.parametrize("rows", [7, 4000])
def test_round_trip(documents, monkeypatch, rows):
    monkeypatch.setattr(order, "PART_ROWS", rows)
    check(documents)


def test_odd_rows(odd, empty):
    check(odd.withColumns({"part": F.lit(1), "ids": F.lit(2), "lent": F.lit(3)}))
    check(odd)
    assert T.round_trip(empty, PATH).count() == 0


def test_sequences_are_read_in_place(tmp_path):
    ids = np.arange(3 * T.SEQUENCE * T.BATCH_ROWS // 2 + 5, dtype=np.uint16)
    writer = T.Writer(f"file://{tmp_path}", 3, np.dtype(np.uint16))
    for own in np.split(ids, [10, 5000, 90_000]):
        writer.add(1, own)
    name, n = writer.close()
    assert n == len(ids) and sorted(p.name for p in tmp_path.iterdir()) == [f"{name}.arrow", f"{name}.docs.arrow"]
    file = T.TokenFile(str(tmp_path), name)
    last = (len(ids) - 1) // T.SEQUENCE
    for i in (0, 1, T.BATCH_ROWS, last):
        found, mask = file.sequence(i)
        wanted = ids[i * T.SEQUENCE : (i + 1) * T.SEQUENCE]
        assert len(found) == T.SEQUENCE and found[: len(wanted)].tolist() == wanted.tolist()
        assert np.array(mask).sum() == len(wanted)
        assert not found.flags.owndata
    assert file.ids(4990, 70_000).tolist() == ids[4990:74_990].tolist()


def test_no_piece_crosses_the_end_of_a_text():
    chunk = next(S.chunks(pa.array(["a ", " b", "  ", "c"])))
    assert set(chunk.offsets[:-1].tolist()) <= set(T.piece_starts(chunk).tolist())
