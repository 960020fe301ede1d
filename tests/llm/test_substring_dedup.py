import random

import plain
import pytest
from plain import SF001

from wiretable.llm import registry
from wiretable.llm.blocks import in_blocks, rows_of
from wiretable.llm.substring_dedup import BLOCK_LEVEL, drop_repeats

SMALL = dict(block_bytes=4000, range_bytes=4000, shard_bytes=1500)
MANY = {**SMALL, "fan_in": 2}


def result(df, **options):
    return sorted(tuple(r) for r in drop_repeats(df, **options).collect())


@pytest.mark.parametrize("options", [{}, SMALL, {**SMALL, "hot_segments": 1}, MANY, {**MANY, "hot_segments": 1}])
def test_against_plain(spark, options):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "dd"]
    rows = [(k, " ".join(rng.choice(vocabulary[:rng.choice([1, 2, 4])]) for _ in range(rng.choice([0, 3, 20, 50, 200]))))
            for k in range(120)] + [(500, None), (501, "x " * 100), (502, "x " * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(df, **options) == plain.kept_words(rows)
    assert result(df, window=6, **options) == plain.kept_words(rows, 6)


def test_odd_rows(spark, odd, odd_rows, empty):
    got = result(odd)
    # Rows of one id follow the order in which they are stored, so only their sums are told here.
    want = plain.kept_words(sorted(odd_rows, key=lambda r: r[0]))
    single = {i for i, _ in odd_rows if sum(j == i for j, _ in odd_rows) == 1}
    assert [r for r in got if r[0] in single] == [r for r in want if r[0] in single]
    assert sum(r[2] for r in got if r[0] == 5) == sum(r[2] for r in want if r[0] == 5)
    assert drop_repeats(empty).count() == 0


def test_null_ids_come_last(spark):
    text = " ".join(f"w{k}" for k in range(30))
    got = {r.doc_id: r.n_removed for r in drop_repeats(spark.createDataFrame([(None, text), (9, text)], "doc_id long, text string")).collect()}
    assert got == {9: 0, None: 30}


def test_query(spark, sf_rows):
    assert sorted(tuple(r) for r in registry.op5_substring_dedup(spark, SF001).collect()) == plain.kept_words(sf_rows)


def test_blocks_of_higher_level_are_smaller_and_read_back(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(900)]
    phrases = [" ".join(rng.choices(words, k=6)) for _ in range(300)]
    rows = [(k, " ".join(rng.choices(phrases, k=70))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sizes = []
    for level in (1, BLOCK_LEVEL):
        blocks = in_blocks(df, level=level).collect()
        assert sorted((r["doc_id"], r["text"]) for b in blocks for r in rows_of(b["payload"]).to_pylist()) == rows
        sizes.append(sum(len(b["payload"]) for b in blocks))
    assert sizes[1] < 0.95 * sizes[0]
