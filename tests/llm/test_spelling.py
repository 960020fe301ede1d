import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from plain import SF001, lower

from wiretable.llm import registry
from wiretable.llm import spelling as S


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows):
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            counts[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_variants(words):
    """The rows of the contract; near words found by all edits of each word."""
    alphabet = sorted({c for w in words for c in w})
    out, forms = {}, {}
    for w, n in words.items():
        edits = {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in alphabet} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        found = [x for x in edits if x in words and x != w]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = len(found)
    rows = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n, out[w], words[forms[w]] if forms[w] else None))
    return rows


def got_rows(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def variants(seed, count, letters="abcdeé"):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 12))) for _ in range(count)]
    for w in list(base):
        i = rng.randrange(len(w))
        base += [w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]]
    return {w: rng.choice([3, 4, 7, 20, 100]) for w in base if len(w) >= 5}


def test_one_edit_is_the_plain_rule():
    words = sorted(variants(1, 40), key=len) + ["é" * 7, "é" * 8, "x" * 5000 + "y", "x" * 5001, "x" * 5001 + "y"]
    data, at = S.latin(pa.array(words))
    assert [data[a:b].tobytes().decode("latin-1") for a, b in zip(at[:-1], at[1:])] == words
    left, right = np.array([(i, j) for i in range(len(words)) for j in range(len(words)) if 0 <= len(words[j]) - len(words[i]) <= 1]).T
    assert S.one_edit(data, at, left, right).tolist() == [near(words[i], words[j]) for i, j in zip(left, right)]


def test_bound_counts_the_grams_of_an_edit():
    grams = S.Grams({"ab", "bc", "abc"}, {}, 5)
    assert grams.decompose("^abcab$") == ["^a", "abca", "bca", "ca", "ab$", "b$"]
    assert grams.bound(["^a", "abca", "bca", "ca", "ab$", "b$"]) == 4


@pytest.mark.parametrize("list_limit", [2000, 6])
def test_links_equal_all_pairs(spark, list_limit):
    words = variants(2, 150) | variants(3, 40, "ab")
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = [(r.a, r.b) for r in S.links(df, frequent=20, list_limit=list_limit).collect()]
    names = sorted(words)
    want = {(a, b) for k, a in enumerate(names) for b in names[k + 1:] if near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_odd_rows(spark, odd, odd_rows, empty):
    rng = random.Random(6)
    bag = variants(4, 60)
    texts = [(200 + k, " ".join(rng.choice(sorted(bag)) + rng.choice(["", "\n", "1", "ÉX×÷"]) for _ in range(80))) for k in range(40)]
    texts += [(None, "Wörter wörter wörter Wörter WÖRTER"), (None, None), (300, ""), (301, "Q" * 3000 + " " + "q" * 3000 + " " + "q" * 3000)]
    docs = odd.select("doc_id", "text", "n_words").unionByName(
        spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, n_words int"))
    assert got_rows(S.group_variants(docs, frequent=30, list_limit=8)) == plain_variants(plain_words([*odd_rows, *texts]))
    assert S.group_variants(empty).count() == 0


def test_roots_of_long_chains(spark):
    forms = [(f"w{k}", f"w{k + 1}") for k in range(37)]
    got = {r.word: r.root for r in S.follow(spark.createDataFrame(forms, "word string, root string")).collect()}
    assert got == {f"w{k}": "w37" for k in range(37)}


def test_query(spark, sf_rows):
    assert got_rows(registry.op11_spelling(spark, SF001)) == plain_variants(plain_words(sf_rows))
