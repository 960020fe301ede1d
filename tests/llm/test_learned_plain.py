"""Language identification and toxicity against plain versions: n-grams, weights, losses and codewords; odds and scores."""

import math
import random
from collections import Counter

import numpy as np
import plain
from plain import SF001
from pyspark.sql import functions as F

from wiretable.llm import language_id as L
from wiretable.llm import registry
from wiretable.llm import toxicity as X


def plain_grams(text):
    """Buckets of the byte pairs and triples of a text, one blank in front and in each gap."""
    body = [b | 0x20 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode()]
    line = [32]
    for b in body:
        if b != 32 or line[-1] != 32:
            line.append(b)
    out = []
    for i in range(len(line)):
        x, y, z = (line + [32, 32])[i:i + 3]
        two = x << 8 | y
        for mixed in (two * 0x9E3779B1 % 2**32, (two << 8 | z) * 0x85EBCA6B % 2**32 ^ 0x5BD1E995):
            out.append((mixed ^ mixed >> 15) % L.BUCKETS)
    return out


def plain_languages(rows):
    """{doc_id: (losses by language)} by the definitions, for rows (doc_id, text, lang)."""
    train = [(plain_grams(t), lang) for i, t, lang in rows if t is not None and lang is not None and plain.fold(i, 5) != 0]
    names = sorted({lang for _, lang in train})
    shares = {}
    for lang in names:
        sums = [0.0] * L.BUCKETS
        for grams, own in train:
            if own == lang:
                for g in grams:
                    sums[g] += 1 / math.sqrt(len(grams))
        whole = sum(sums) + L.SMOOTHING * L.BUCKETS
        shares[lang] = [(x + L.SMOOTHING) / whole for x in sums]
    code = {lang: L.codewords(len(names))[k].tolist() for k, lang in enumerate(names)}
    weights = []
    for bit in range(len(code[names[0]])):
        mean = {s: [sum(x) / len(x) for x in zip(*(shares[n] for n in names if code[n][bit] == s))] for s in (1, -1)}
        weights.append([math.log(a / b) for a, b in zip(mean[1], mean[-1])])

    def margins(grams):
        return [sum(w[g] for g in grams) / math.sqrt(len(grams)) for w in weights]

    right = [1] * len(weights)
    for grams, lang in train:
        for bit, m in enumerate(margins(grams)):
            right[bit] += m * code[lang][bit] > 0
    trust = [min(max(r / (len(train) + 2), 0.51), 1 - 1e-6) for r in right]
    trust = [math.log(p / (1 - p)) for p in trust]
    trust = [t / (sum(trust) / len(trust)) for t in trust]
    out = {}
    for i, text, _ in rows:
        m = margins(plain_grams(text or ""))
        out[i] = {n: sum(t * math.log1p(math.exp(-x * c)) for t, x, c in zip(trust, m, code[n])) for n in names}
    return out


def test_languages_against_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang").collect()]
    want = plain_languages(rows)
    got = {r.doc_id: r for r in registry.op4_language_id(spark, SF001).collect()}
    assert set(got) == set(want)
    judged = 0
    for i, text, _ in rows:
        if not any(c.isalpha() for c in text or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        ranked = sorted(want[i].items(), key=lambda x: x[1])
        score = 1 / sum(math.exp(ranked[0][1] - loss) for _, loss in ranked)
        assert abs(got[i].score - score) < 1e-3
        if ranked[1][1] - ranked[0][1] > 1e-3:  # no tie within float32
            judged += 1
            assert got[i].lang_pred == ranked[0][0]
    assert judged > 0.9 * len(rows)


def plain_features(token):
    return {("", token)} | {(n, token[:n]) for n in X.PREFIXES if len(token) > n}


def test_toxicity_against_plain(spark):
    rng = random.Random(21)
    rows = []
    for k in range(400):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(10, 60))]
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * 3):
            words.insert(rng.randrange(len(words)), rng.choice(["vilething", "vilethings", "scum", "grossness"]))
        rows.append((k, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    model = X.learn(docs.drop("toxic"), docs.selectExpr("doc_id", "toxic AS label"), F.lit(True))

    sizes, seen = Counter(t for *_, t in rows), Counter()
    for _, text, toxic in rows:
        seen.update((f, toxic) for f in {f for w in text.split() for f in plain_features(w)})
    weights = {}
    odds = lambda y, n: math.log((y + X.PRIOR) / (n - y + X.PRIOR))
    for f in {f for f, _ in seen}:
        y1, y0 = seen[f, 1], seen[f, 0]
        g2 = 2 * sum(y * math.log(y / ((y1 + y0) * sizes[t] / len(rows))) for y, t in ((y1, 1), (y0, 0)) if y)
        ratio = odds(y1, sizes[1]) - odds(y0, sizes[0])
        least = X.CAUTION * math.sqrt(1 / (y1 + X.PRIOR) + 1 / (y0 + X.PRIOR))
        if g2 >= X.LEAST_G2 and abs(ratio) > least:
            weights[f] = ratio - math.copysign(least, ratio)
    assert weights and np.allclose(sorted(model.weights), sorted(weights.values()))

    def token(word):
        return max((weights.get(f, 0.0) for f in plain_features(word)), key=abs) - X.DRIFT

    def best(text):
        top = run = 0.0
        for word in text.split():
            run = max(0.0, run + token(word))
            top = max(top, run)
        return top

    clean = [round(token(w), 3) for _, t, toxic in rows if not toxic for w in t.split()]
    values = Counter(clean)
    values[max(1.0, *weights.values())] += 0.5
    mean = sum(n * math.exp(model.lam * v) for v, n in values.items()) / sum(values.values())
    assert abs(mean - 1) < 1e-6

    # The curve is where the penalised likelihood is flat, and the query's scores lie on it.
    x = np.array([model.lam * best(t) - math.log(X.K * len(t.split())) for _, t, _ in rows])
    y = np.array([t for *_, t in rows])
    a, b = model.curve
    p = 1 / (1 + np.exp(-(a + b * x)))
    shift, scale = x.mean(), x.std()
    assert abs((y - p).sum() - 1e-3 * (a + b * shift)) < 1e-3
    assert abs(((y - p) * (x - shift) / scale).sum() - 1e-1 * b * scale) < 1e-3
    found = {r.doc_id: r.score for r in X.score_toxicity(docs.drop("toxic"), docs.drop("text"), F.lit(True)).collect()}
    assert np.allclose([found[k] for k, *_ in rows], p)
