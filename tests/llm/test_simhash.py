import random

import numpy as np
import plain
import pytest
from plain import SF001
from pyspark.sql import functions as F

from wiretable.llm import registry
from wiretable.llm.components import connected_components
from wiretable.llm.simhash import forest, keep_one, links, near_duplicates, trie_links


def test_trie_join_equals_all_pairs():
    rng = np.random.default_rng(2)
    for bits, budget in ((10, 3), (64, 3), (8, 0), (6, 2)):
        base = rng.integers(0, 1 << min(bits, 62), 40).astype(np.uint64)
        flips = np.uint64(1) << rng.integers(0, bits, 200).astype(np.uint64)
        leaves = np.unique(np.concatenate([base, rng.choice(base, 200) ^ flips]))
        n = len(leaves)
        left, right = trie_links(leaves, np.array([0]), np.array([n]), np.array([0]), np.array([n]), bits, budget)
        near = np.bitwise_count(leaves[:, None] ^ leaves[None, :]) <= budget
        assert (np.bitwise_count(leaves[left] ^ leaves[right]) <= budget).all()
        assert (forest(n, left, right) == forest(n, *np.nonzero(near))).all()


@pytest.mark.parametrize("limit", [4096, 3])
def test_links_with_opened_nodes(spark, limit):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = sorted({b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(12)})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = links(spark.createDataFrame(signed, "fp long"), node_limit=limit)
    root = {r.node: r.root for r in connected_components(edges).collect()}
    got = [root.get(s[0], s[0]) for s in signed]
    want = plain.components([(k, p) for k, p in enumerate(prints)])
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_components_of_paths_and_hubs(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{100 + k: 100 for k in range(1, 30)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_rows(odd, odd_rows, empty):
    prints = [(i, plain.fingerprint(t)) for i, t in odd_rows]
    want = sorted((i, p, c) for (i, p), c in zip(prints, plain.components(prints)))
    got = sorted((r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in near_duplicates(odd).collect())
    assert got == want
    assert near_duplicates(empty).count() == 0 and keep_one(empty).columns == empty.columns


def test_null_ids_come_last(spark):
    rows = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (None, "q r s t u v"), (None, "q r s t u v")], "doc_id long, text string")
    got = sorted(near_duplicates(rows).select("doc_id", "component_id").collect(), key=str)
    assert [tuple(r) for r in got] == sorted([(None, 7), (7, 7), (None, None), (None, None)], key=lambda r: f"Row(doc_id={r[0]}, component_id={r[1]})")
    assert keep_one(rows).count() == 2


def test_one_of_each_group_stays(odd, odd_rows):
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    prints = [(i, plain.fingerprint(t)) for i, t in odd_rows]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(plain.components(prints, groups=True))


def test_query(spark, sf_rows):
    prints = [(i, plain.fingerprint(t)) for i, t in sf_rows]
    want = {i: (format(p, "016x"), c) for (i, p), c in zip(prints, plain.components(prints))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in registry.op2_simhash(spark, SF001).collect()}
    assert got == want


def test_fingerprint_of_spark_hash(spark):
    # The hash is the one that Spark's xxhash64 gives for a string.
    text = "one two three"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] & (2 ** 64 - 1) == plain.fingerprint(text)
