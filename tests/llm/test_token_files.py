import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from plain import SF001
from tokenizers import Tokenizer

from wiretable.llm import byte_tokens as BT
from wiretable.llm import registry
from wiretable.llm import token_files as TF
from wiretable.llm import tokens as T
from wiretable.llm.memo import WordMemory


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TF.MODEL)


def plain_rows(library, rows):
    """(id, start, tokens, crc32) of (id, text) rows in order."""
    out, start = [], 0
    for name, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [TF.END_ID]
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


class Buffer(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_ids_are_those_of_the_library(library, sf_rows, odd_rows):
    rng = random.Random(5)
    letters = "ab  \n\t'sé  　日ß1٣<|endoftext|>.,!\x1c\x85😀ж"
    texts = [t or "" for _, t in [*sf_rows, *odd_rows]] + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["a <|endoftext|> b", " x", "x ", "", " "]
    for plain in (False, True):
        library.encode_special_tokens = plain
        coder = BT.ByteTokens(BT.read_model(TF.MODEL), plain)
        data, docs = T.utf8(pa.array(texts))
        ids, first = BT.encode_bytes(data, docs, coder, WordMemory(limit=300))
        got = [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
        assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    library.encode_special_tokens = False


def one_file(lists, **sizes):
    out = Buffer()
    writer = TF.Writer(out, **sizes)
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    writer.add(np.arange(len(lists)), np.zeros(len(lists), bool), np.array([i for x in lists for i in x], np.int64), first)
    assert writer.close() == out.size()
    return out


def test_file_is_plain_zstandard_and_seekable():
    rng = random.Random(1)
    lists = [[rng.randrange(60_000) for _ in range(n)] for n in (3, 0, 5000, 1, 7, 40, 900, 2, 0)]
    out = one_file(lists, frame_bytes=400, longest=1000)
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True) as stream:
        assert stream.read() == np.array([i for x in lists for i in x], "<u4").tobytes()
    reader = TF.Reader(out)
    begins = [0, *reader.ends[:-1].tolist()]
    assert [np.frombuffer(reader.ids(a, b), "<u4").tolist() for a, b in zip(begins, reader.ends.tolist())] == lists
    assert np.diff(reader.plain).max() <= 1000 and len(reader.plain) > 20


def test_only_the_frames_of_a_document_are_read():
    lists = [[k] * 100 for k in range(50)]
    reader = TF.Reader(one_file(lists, frame_bytes=800, longest=4000))
    seen = []
    plain = reader.frame
    reader.frame = lambda k: seen.append(k) or plain(k)
    assert np.frombuffer(reader.ids(2100, 2200), "<u4").tolist() == lists[21] and len(seen) == 1


def test_damage_is_found():
    out = one_file([[1, 2, 3]] * 400, frame_bytes=800)
    body = bytearray(out.getvalue())
    reader = TF.Reader(Buffer(bytes(body)))
    reader.check = reader.check.copy()
    reader.check[1] ^= 1
    with pytest.raises(ValueError, match="frame 1"):
        reader.ids(0, 1200)
    with pytest.raises(ValueError, match="index"):
        at = int(reader.at[-2])
        TF.Reader(Buffer(bytes(body[:at + 20] + bytes([body[at + 20] ^ 1]) + body[at + 21:])))
    with pytest.raises(ValueError, match="seek table"):
        TF.Reader(Buffer(bytes(body[:-1] + b"\0")))


def test_odd_rows_round_trip(spark, odd, odd_rows, empty, library, scratch):
    rows = odd_rows + [(None, "no id"), (None, None)]
    docs = odd.select("doc_id", "text", "n_words", "row").unionByName(spark.createDataFrame(
        [(None, "no id", 1, True), (None, None, 1, True)], "doc_id long, text string, n_words int, row boolean"))
    TF.write_tokens(docs, f"{scratch}/a", frame_bytes=500)
    got = TF.read_tokens(spark, f"{scratch}/a", with_crc=True).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(i), n, c) for i, _, n, c in plain_rows(library, rows))
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([i for i, _ in odd_rows]) + [None, None]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    wanted = spark.createDataFrame([(3,), (5,), (121,), (999,), (-1,), (None,), (3,)], "doc_id long")
    some = TF.read_documents(spark, f"{scratch}/a", wanted, with_crc=True).collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in some) == sorted(
        (r.doc_id, r.start, r.ids_crc32) for r in got if r.doc_id in (3, 5, 121))
    TF.write_tokens(empty, f"{scratch}/b")
    assert TF.read_tokens(spark, f"{scratch}/b").count() == 0
    assert TF.read_documents(spark, f"{scratch}/b", wanted).count() == 0


def test_query(spark, sf_rows, library):
    got = sorted(tuple(r) for r in registry.op12_token_files(spark, SF001).collect())
    assert got == plain_rows(library, sf_rows)
