import random

import pyarrow as pa
import sentencepiece
from plain import SF001

from wiretable.llm import registry
from wiretable.llm.memo import WordMemory
from wiretable.llm.sentencepiece_codec import MARK, MODEL, Pieces, _model, decode, decode_ids, encode, encode_texts

ODD = ["", "  ", "a  b   c", "日本語テスト 😀\x00x", "foo▁bar ▁", "\n\n  x\t\ty", "a" * 900, " " * 100 + "x", " ▁ ▁▁  y"]


def test_ids_are_those_of_the_library(sf_rows):
    rng = random.Random(3)
    letters = "abcdefgh ▁\n1234éñß{}();\r\t .,=-_<>/"
    texts = [t or "" for _, t in sf_rows] + ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(800)]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = Pieces(_model(MODEL))
    ids, first = encode_texts(pa.array(texts), pieces, WordMemory(limit=500))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == library.encode(texts)
    assert [x.decode() for x in decode_ids(ids, first, pieces)] == [t.replace(MARK, " ") for t in texts]


def test_prefixes_are_shared():
    pieces = Pieces(_model(MODEL))
    words = sorted({MARK + "inter" + x for x in ("", "n", "national", "nationally", "net", "rupt")})
    alone = [Pieces.encode_sorted(pieces, [w])[0] for w in words]
    assert pieces.encode_sorted(words) == alone


def test_round_trip_of_odd_rows(spark, odd, odd_rows, empty):
    found = encode(odd)
    texts = sorted((r.doc_id, r.text) for r in decode(found).collect())
    assert texts == sorted((i, (t or "").replace(MARK, " ")) for i, t in odd_rows)
    assert encode(empty).count() == 0 and decode(encode(empty)).count() == 0
    assert decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")).collect() == [(1, ""), (2, "")]


def test_query(spark, sf_rows):
    rows = registry.op9_sentencepiece(spark, SF001).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert all(r.round_trip for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(library.encode(t or "")) for i, t in sf_rows}
