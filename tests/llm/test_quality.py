import math
import random

import plain
import pytest
from plain import SF001

from wiretable.llm import registry
from wiretable.llm.quality import common_words, judge, measures, nearest, reference_rows, without_common


def test_odd_rows(odd, odd_rows, empty):
    got = sorted((r.doc_id, *tuple(r)[1:7]) for r in judge(odd).collect())
    assert got == sorted((i, *plain.quality(t)) for i, t in odd_rows)
    assert judge(empty).count() == 0


def test_plan_is_native(spark, odd):
    plan = measures(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_distance_is_jensen_shannon(spark):
    row = spark.createDataFrame([([3, 1, 0],), ([0, 0, 0],)], "h array<bigint>")
    p, q = [0.75, 0.25, 0.0], [0.2, 0.3, 0.5]
    want = math.sqrt(sum((a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0) for a, b in zip(p, q)) / 2)
    got = [r[0] for r in row.select(nearest(row.h, [q, [0.0, 0.0, 1.0]])).collect()]
    assert got[0] == pytest.approx(want) and got[1] is None
    assert row.select(nearest(row.h, [])).first()[0] is None


COMMON = {"en": "the of and to in is that it for on".split(), "xx": "ka lo mi ne pu ra se ti vo wa".split()}


def prose(lang, seed, size=120, share=0.3):
    """Words of letters only; in clean prose a share of them are the language's common words."""
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(COMMON[lang]) if rng.random() < share else "".join(rng.choice("abcdefghilmnoprstu") for _ in range(7))
                    for _ in range(size))


def judged(spark, rows):
    return {r.doc_id: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}


def clean_rows():
    return [(100 * k + i, prose(lang, i), lang) for k, lang in enumerate(COMMON) for i in range(30)]


def test_far_by_characters(spark):
    noise = " ".join(f"{k}%%%%$$$$###" for k in range(120))
    got = judged(spark, clean_rows() + [(999, noise, "en"), (998, "short clean text", None)])
    assert got[0].kept and not got[0].base_failed and not got[999].kept and not got[999].base_failed
    assert (got[998].base_failed, got[998].kept) == (True, False)
    assert all(r.kept for i, r in got.items() if i < 900)


def test_only_the_word_histogram_rejects(spark):
    """Prose of the same letters without common words: from 50 words on, and only by words."""
    bare = [(900 + n, prose("en", n, size=n, share=0.0), lang) for n, lang in ((50, "en"), (70, None), (150, "xx"), (400, "en"))]
    short = [(2000 + n, prose("en", n, size=n), "en") for n in (50, 60, 80)]
    got = judged(spark, clean_rows() + bare + short)
    chars = max(r.char_distance for i, r in got.items() if i < 900)
    for i, _, _ in bare:
        assert not got[i].kept and not got[i].base_failed and got[i].word_distance >= 0.999 and got[i].char_distance < 0.2, i
    assert chars < 0.2 and all(got[i].kept for i, _, _ in short)


def test_languages_and_common_words_are_learned(spark):
    """A language of a few documents, and documents that fail the base rules, are no reference."""
    few = [(3000 + k, " ".join(["junk"] * 30 + [f"zz{k}{j}" for j in range(60)]), "zz") for k in range(19)]
    failed = [(4000 + k, "same words here " * 30, "yy") for k in range(40)]
    measured = measures(spark.createDataFrame(clean_rows() + few + failed, "doc_id long, text string, lang string"))
    rows, langs = reference_rows(measured)
    assert sorted(langs) == ["en", "xx"] and set(COMMON["en"] + COMMON["xx"]) == set(common_words(rows, 10))
    few = judged(spark, clean_rows() + [(5000 + k, prose("en", k, share=0.0), "zz") for k in range(3)])
    assert all(few[5000 + k].kept and few[5000 + k].word_distance > 0.99 for k in range(3))  # no reference for its language
    many = judged(spark, [(k, prose("en", k, 60), f"l{k}") for k in range(1100)])
    assert all(r.kept and r.word_distance is None for r in many.values())


def test_distance_without_common_words():
    share = [0.1, 0.07, 0.83]
    m = [(a + b) / 2 for a, b in zip(share, [0, 0, 1])]
    want = math.sqrt(sum(x * math.log2(x / y) for p in (share, [0, 0, 1]) for x, y in zip(p, m) if x) / 2)
    assert without_common(share) == pytest.approx(want) and without_common([0.5, 0.5, 0.0]) == pytest.approx(1.0)


def test_query(spark, sf_rows):
    got = {r.doc_id: tuple(r)[1:7] for r in registry.op3_quality(spark, SF001).collect()}
    assert got == {i: plain.quality(t) for i, t in sf_rows}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    rows = registry.op3_quality(spark, SF001).collect()
    assert all(r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed)
    assert not any(r.kept for r in rows if r.base_failed)
