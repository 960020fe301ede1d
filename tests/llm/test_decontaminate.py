import numpy as np
import plain
import pytest
from plain import SF001

from wiretable.llm import registry
from wiretable.llm.decontaminate import decontaminate
from wiretable.llm.fm_index import FMIndex, WaveletMatrix


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(1)
    for _ in range(30):
        text = np.append(rng.integers(0, 4, rng.integers(1, 60)), 0)
        index = FMIndex(text, 4, rate=3).compress()
        for size in (1, 2, 4):
            pattern = rng.integers(1, 4, size)
            low, high = index.search(pattern, np.array([size]), np.array([size]))
            got = sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist())
            assert got == [i for i in range(len(text) - size + 1) if (text[i:i + size] == pattern).all()]


def test_wavelet_ranks():
    rng = np.random.default_rng(2)
    for n in (0, 1, 64, 65, 500):
        symbols = rng.integers(0, 9, n)
        matrix = WaveletMatrix(symbols, 9)
        at, which = rng.integers(0, n + 1, 50), rng.integers(0, 9, 50)
        assert matrix.rank(which, at).tolist() == [int((symbols[:a] == w).sum()) for a, w in zip(at, which)]
        if n:
            got, ranks = matrix.access(np.arange(n))
            assert (got == symbols).all() and ranks.tolist() == [int((symbols[:i] == symbols[i]).sum()) for i in range(n)]


ITEMS = [(1, "one two THREE alpha"), (2, None), (3, "!!"), (4, "x x x x x x x x x x x x"), (5, "été"), (6, "one two THREE alpha")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 16])
def test_odd_rows(spark, odd, odd_rows, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    found = decontaminate(odd, items, block_bytes=block_bytes, with_text=True, carry=True)
    got = sorted((r.doc_id, r.n_words, r.n_hit, len(r["items"]), plain.sha(",".join(r["items"])), r.n_hit > 0) for r in found.collect())
    assert got == sorted((i, *x) for (i, _), x in zip(odd_rows, plain.contamination([t for _, t in odd_rows], ITEMS)))
    for r in found.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
        assert len(plain.ALNUM.findall(plain.lower(r.clean_text))) == r.n_words - r.n_hit
        if not r.n_hit:
            assert r.clean_text == (r.row.text or "")


@pytest.mark.parametrize("block_bytes", [1 << 20, 16])
def test_items_without_an_id_hit_and_are_not_listed(spark, block_bytes):
    docs = spark.createDataFrame([(1, "a b see the Hidden passage here"), (2, "hidden passage, other words"), (3, "none")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "hidden passage"), (None, "see"), (7, "other words"), (None, None)], "item_id int, text string")
    found = decontaminate(docs, items, block_bytes=block_bytes, with_text=True).collect()
    got = {r.doc_id: (r.n_hit, list(r["items"]), r.clean_text.split()) for r in found}
    assert got == {1: (3, [], ["a", "b", "the", "here"]), 2: (4, ["7"], got[2][2]), 3: (0, [], ["none"])}
    assert "hidden" not in got[2][2]


def test_empty_tables(spark, odd, empty):
    nothing = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate(empty, nothing).count() == 0
    assert {r.n_hit for r in decontaminate(odd, nothing).collect()} == {0}


def test_query(spark, sf_rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = {i: x for (i, _), x in zip(sf_rows, plain.contamination([t for _, t in sf_rows], items))}
    assert {r.doc_id: tuple(r)[1:] for r in registry.op8_decontaminate(spark, SF001).collect()} == want
