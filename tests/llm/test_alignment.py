import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from plain import SF001, sha
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wiretable.llm import alignment as AL
from wiretable.llm import blocks as B
from wiretable.llm import byte_tokens as BT
from wiretable.llm import registry
from wiretable.llm.corpus_sums import ASKED, corpus_values, requests


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(AL.BYTE_MODEL)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=AL.PIECE_MODEL)
    chars = AL.byte_characters()

    def tokens(text):
        """(id, bytes) of both sides; none where they do not spell the blank and the text."""
        if not text:
            return [], []
        a = [(i, bytes(chars[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(second.id_to_piece(i)[1:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode())
             for i in second.encode(text)]
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])
    return tokens


def plain_alignment(tokens, rows):
    """The rows of the contract from pairwise comparisons."""
    docs, counts = [], Counter()
    for name, text in rows:
        a, b = tokens(text)
        sides = []
        for side in (a, b):
            at, spans = 0, []
            for i, x in side:
                spans.append((i, at, at + len(x)))
                at += len(x)
            sides.append(spans)
        links = []
        for i, s, e in sides[0]:
            links += [(i, j) for j, t, u in sides[1] if s < u and t < e]
        shared = sorted({e for _, _, e in sides[0]} & {e for _, _, e in sides[1]})
        parts, low = [], 0
        for end in shared:
            parts.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in sides))
            low = end
        counts.update(links)
        docs.append((name, len(a), len(b), len(shared), links, ";".join(parts)))
    best = defaultdict(int)
    for (i, j), n in counts.items():
        best[j] = max(best[j], n)
    return [(name, na, nb, g, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
             sha(text) if text else "") for name, na, nb, g, links, text in docs]


ODD = ["a▁b", "<|endoftext|> x <s> </s>", "日本語テスト 😀 ß", " ", "  ", "x ", " x", "\n\n\t x", "naïve café 1234567", "\x00 a", "ﬁ ＡＢ", "é"]


def test_odd_rows(spark, odd, odd_rows, empty, libraries):
    more = [(500 + k, t) for k, t in enumerate(ODD)]
    docs = odd.select("doc_id", "text", "n_words").unionByName(
        spark.createDataFrame([(i, t, 1) for i, t in more], "doc_id long, text string, n_words int"))
    short = [(i, t) for i, t in odd_rows + more if len(t or "") < 3000]
    got = AL.align(docs.where("coalesce(length(text), 0) < 3000"), with_digests=True, block_bytes=4000, range_keys=300, fan_in=3)
    rows = got.collect()
    assert sorted(tuple(r)[:7] + (r.groups_sha256,) for r in rows) == sorted(plain_alignment(libraries, short))
    assert all(r.groups_sha256 == (sha(r.groups) if r.groups else "") for r in rows)
    assert AL.align(empty).count() == 0
    assert AL.align(spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")).select("n_a", "n_links").distinct().count() == 1


def test_chunk_of_random_texts(libraries):
    rng = random.Random(8)
    letters = "ab  \n'sé▁日ß1😀.<|>x"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(800)]
    with open(AL.PIECE_MODEL, "rb") as f:
        tk = AL.Tokenizers(BT.read_model(AL.BYTE_MODEL), f.read())
    chunk = AL.Chunk(pa.array(texts), tk)
    want = plain_alignment(libraries, list(enumerate(texts)))
    assert [(a, b, g, n) for a, b, g, n in zip(chunk.n_a, chunk.n_b, chunk.groups, chunk.links)] == [w[1:5] for w in want]
    assert [sha(x.decode()) if x else "" for x in chunk.texts(tk)] == [w[7] for w in want]


def test_pointers_reach_the_end_of_long_groups():
    first = np.arange(2, 4001, 2)
    second = np.append(np.arange(1, 4000, 2), 4000)
    end = AL.terminals(first, second)
    assert set(end.tolist()) == {len(first) + len(second) - 1}


@pytest.mark.parametrize("fan_in", [2, 5, 100])
def test_sums_of_many_blocks(spark, fan_in):
    """A key that every block holds meets at most ``fan_in`` rows in a call."""
    rng = np.random.default_rng(3)
    held = {k: np.unique(np.append(rng.integers(0, 1 << 63, 30).astype(np.uint64) & np.uint64(0xFF00000000000003), 0).astype(np.uint64))
            for k in range(40)}
    asked = spark.createDataFrame([tuple(r.values()) for k, keys in held.items()
                                   for r in requests(k, keys, np.full(len(keys), k + 1), 3).to_pylist()], ASKED)
    total = Counter()
    for k, keys in held.items():
        total.update({x: k + 1 for x in keys.tolist()})

    def value(keys, sums):
        assert len(keys) == len(set(keys.tolist()))
        return sums * 3

    rows = corpus_values(asked, 40, value, lambda keys: keys > 0, fan_in).orderBy("part").collect()
    for k, keys in held.items():
        got = np.concatenate([B.unpack(r["values"]) for r in rows if r.block == k])
        assert got.tolist() == [3 * total[x] for x in keys.tolist()]
    assert sum(r.n for r in rows) == sum(v for x, v in total.items() if x) and sum(r.kinds for r in rows) == len(total) - 1


def test_query(spark, libraries):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.doc_id: r for r in registry.op13_alignment(spark, SF001).collect()}
    short = [(r.doc_id, r.text) for r in docs.where(F.length("text") < 1500).collect()]
    for name, na, nb, g, links, _, _, digest in plain_alignment(libraries, short):
        r = got[name]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (na, nb, g, links, digest)
    assert len(got) == docs.count()
