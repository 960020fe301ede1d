"""Language identification and toxicity: held-out accuracy, and the parts against plain versions."""

import random

import numpy as np
import plain
from pyspark.sql import functions as F

from wiretable.llm import registry
from wiretable.llm.language_id import codewords, even_share, identify
from wiretable.llm.toxicity import best_segments, decay, learn, maximal_segments, score_toxicity

SF01 = "/root/testdata/sf0.01"


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12, 40):
        code = codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (2 ** (n - 2) if n <= 7 else 8)


def test_languages_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    rows = registry.op4_language_id(spark, SF01).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all(r.held_out == (plain.fold(r.doc_id, 5) == 0) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_rows(spark, odd, odd_rows, empty):
    got = sorted((r.doc_id, r.lang_pred) for r in identify(odd).collect())
    has = lambda t: any(c.isalpha() for c in t or "")
    assert got == sorted((i, "en" if has(t) else "und") for i, t in odd_rows)
    assert identify(empty).count() == 0
    one = spark.createDataFrame([(1, "abc", None), (2, None, "fr")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in identify(one).collect()} == {"und"}


def test_rare_languages_are_learned_at_every_size(spark):
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(6))
    rows = [(k, " ".join(word(letters) for _ in range(30)), lang)
            for k, (lang, letters) in enumerate([("aa", "abcdef"), ("bb", "ghijkl")] * 1500 + [("cc", "mnopqr")] * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in identify(docs, sample_rows=20).collect()}
    assert got == {i: lang for i, _, lang in rows}
    assert even_share([5, 100, 1000], 45) == 20 and even_share([5, 7], 45) == 7 and even_share([], 45) == 0


def test_segments_against_plain():
    rng = random.Random(3)
    for _ in range(200):
        scores = [rng.choice([-3, -2, -1, 1, 2, 4]) + 0.5 for _ in range(rng.randrange(0, 25))]
        sums = {(a, b): sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
        best = max([0, *sums.values()])
        got = maximal_segments(scores)
        assert max([0, *(s for *_, s in got)]) == best
        assert all(abs(sums[a, b] - s) < 1e-9 for a, b, s in got)
        # Maximal: every proper part of a segment scores less, and segments do not overlap.
        assert all(sums[c, d] < s for a, b, s in got for c in range(a, b) for d in range(c + 1, b + 1) if (c, d) != (a, b))
        assert all(x[1] <= y[0] for x, y in zip(got, got[1:]))
    docs = [[rng.uniform(-2, 1) for _ in range(rng.randrange(0, 9))] for _ in range(30)]
    first = np.cumsum([0, *map(len, docs)])
    want = [max([0, *(sum(d[a:b]) for a in range(len(d)) for b in range(a + 1, len(d) + 1))]) for d in docs]
    assert np.allclose(best_segments(np.array(sum(docs, [])), first), want)


def test_decay_solves_its_equation():
    values, counts = np.array([-1.0, 2.0]), np.array([0.9, 0.1])
    lam = decay(values, counts)
    assert abs((counts * np.exp(lam * values)).sum() - 1) < 1e-6


def test_toxicity_held_out(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    bad = ["vilething", "grossness", "scumbag"]
    rows, labels = [], []
    for k in range(600):
        w = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(1 + len(w) // 20):
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "s", ",", "ly"]))
        rows.append((k, " ".join(w)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in found if plain.fold(r.doc_id, 5) == 0]
    assert sum((r.score >= 0.5) == bool(truth[r.doc_id]) for r in held) >= 0.97 * len(held)
    hit = next(r for r in found if truth[r.doc_id] and r.passages)
    w = rows[hit.doc_id][1].split()
    assert all(any(x.startswith(tuple(bad)) for x in w[p.start:p.end]) for p in hit.passages)


def variants(pairs):
    """Clean texts, and behind them their toxic variants."""
    rng = random.Random(5)
    clean = [" ".join(f"w{rng.randrange(400)}" for _ in range(80 + k % 40)) for k in range(pairs)]
    return [(k, t, 0) for k, t in enumerate(clean)] + [(pairs + k, t + " vilething", 1) for k, t in enumerate(clean)]


def test_toxic_variants_of_clean_texts_are_learned_from(spark):
    base = variants(60)
    rows = [(k, f"{t} copy{k}", 0) for k, (_, t, _) in enumerate([x for x in base if not x[2]] * 9)]
    rows += [(1000 + k, t, 1) for k, t, toxic in base if toxic]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").coalesce(1)
    found = score_toxicity(docs.drop("toxic"), docs.drop("text")).collect()
    held = [r for r in found if plain.fold(r.doc_id, 5) == 0]
    assert sum((r.score >= 0.5) == (r.doc_id >= 1000) for r in held) >= 0.97 * len(held)


def test_toxicity_model_is_the_same_for_any_order_of_rows(spark):
    rows = [(3 * i + k, t + f" tail{k}" * k, label) for i, t, label in variants(100) for k in range(3)]
    models = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, toxic int").repartition(3 if order is rows else 5)
        models.append(learn(docs.drop("toxic"), docs.selectExpr("doc_id", "toxic AS label"), F.lit(True)))
    a, b = models
    assert len(a.keys) and a.keys.tolist() == b.keys.tolist() and a.weights.tolist() == b.weights.tolist()
    assert a.lam == b.lam and a.curve == b.curve


def test_toxicity_of_odd_rows(spark, odd, odd_rows, empty):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    got = score_toxicity(odd, none, carry=True).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in odd_rows) and {r.score for r in got} == {0.0}
    some = spark.createDataFrame([(i, int(i % 2)) for i in range(60)] + [(3, 0)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in score_toxicity(odd, some).collect())
    assert score_toxicity(empty, some).count() == 0


def test_toxicity_query(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = registry.op6_toxicity(spark, SF01).collect()
    clean = [r for r in rows if truth.get(r.doc_id) == 0]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    rank = lambda want: [r.score for r in rows if truth.get(r.doc_id) == want]
    pairs = [(a > b) + 0.5 * (a == b) for a in rank(1) for b in rank(0)]
    assert sum(pairs) / len(pairs) > 0.8  # 46 toxic rows to learn from, in four languages
