"""Language identification by error-correcting output codes.

Each language has a codeword; each bit of the code is a question "is the language
in this half?", answered by a binary classifier over hashed byte n-grams (two and
three bytes of the lower-cased text, everything but letters read as one blank).
The classifier's weights are log ratios of the mean n-gram shares of both halves.
Decoding adds, per codeword, the logistic loss of every bit's margin, weighted by
how well the bit is told apart on the sample, and takes the codeword of least
loss; a small lead over the next codeword is flagged as ambiguous.

Learning uses a bounded sample of labelled rows, chosen by a hash of the id:
``sample_rows`` dealt over the languages, so that small ones are taken whole and
the others give equally many, and about ``LEAST_ROWS`` of each at least.  A rare
language is thus learned at every size.  Up to seven languages get the exhaustive code, more get random
codewords (fixed seed) of 15 log2(languages) bits with distinct rows and columns.

Defined results: null texts and texts without a letter are ``und`` with score 0;
rows with null language are not learned from; without any learned language all is
``und``; one learned language is always taken; repeated rows are judged one by
one; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretable.llm import tokens as T
from wiretable.llm.frames import fold, keyed, stored

SAMPLE_ROWS = 20_000
#: Rows of a language in the sample at least, if it has as many; with very many languages the sample grows by these.
LEAST_ROWS = 100
BUCKETS = 1 << 14
SMOOTHING = 0.5
AMBIGUOUS = 0.2
SAMPLE_TASKS = 8

#: Letters a-z (after lower-casing) and all bytes beyond ASCII stay; the rest reads as a blank.
LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTERS[0x80:] = np.arange(0x80, 0x100)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams (pairs, then triples) of each document: buckets and document starts, and letters seen."""
    data, docs = T.utf8(texts)
    body = LETTERS[data]
    body[docs[-1]:] = 0x20
    doc = np.repeat(np.arange(len(docs) - 1), np.diff(docs))
    # One blank in front of each document, and never two blanks in a row.
    body, doc = np.insert(body[:docs[-1]], docs[:-1], 0x20), np.insert(doc, docs[:-1], np.arange(len(docs) - 1))
    keep = np.ones(len(body), bool)
    keep[1:] = (body[1:] != 0x20) | (body[:-1] != 0x20) | (doc[1:] != doc[:-1])
    body, doc = body[keep].astype(np.uint32), doc[keep]
    first = np.searchsorted(doc, np.arange(len(docs)))
    letters = np.add.reduceat(body != 0x20, first[:-1]) if len(body) else np.zeros(0, np.int64)
    pad = np.append(body, np.array([0x20, 0x20], np.uint32))
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, bool)
    two = pad[:-2] << np.uint32(8) | np.where(last, np.uint32(0x20), pad[1:-1])
    near = np.append(last[1:], True) if len(last) else last
    three = two << np.uint32(8) | np.where(last | near, np.uint32(0x20), pad[2:])
    mixed = np.stack([two * np.uint32(0x9E3779B1), three * np.uint32(0x85EBCA6B) ^ np.uint32(0x5BD1E995)], 1)
    mixed ^= mixed >> np.uint32(15)
    return (mixed % np.uint32(BUCKETS)).reshape(-1).astype(np.int64), 2 * first, letters


def codewords(languages: int) -> np.ndarray:
    """+1 and -1 per language and bit."""
    if languages == 1:
        return np.ones((1, 1))
    if languages <= 7:
        bits = 2 ** (languages - 1) - 1
        rows = [[1] * bits]
        for k in range(1, languages):
            run = 2 ** (languages - 1 - k)
            rows.append([-1 if (b // run) % 2 == 0 else 1 for b in range(bits)])
        return np.array(rows, float)
    rng = np.random.default_rng(7)
    bits = math.ceil(15 * math.log2(languages))
    while True:
        code = np.where(rng.random((languages, bits)) < 0.5, -1.0, 1.0)
        if len(np.unique(code, axis=0)) == languages and (np.abs(code.sum(0)) < languages).all():
            return code


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages)) if languages else np.zeros((0, 0))
        share = (counts + SMOOTHING) / (counts.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
        weights = []
        for bit in self.code.T:
            halves = [np.log(share[bit == s].mean(0)) if (bit == s).any() else None for s in (1, -1)]
            weights.append(halves[0] - halves[1] if all(h is not None for h in halves) else np.zeros(BUCKETS))
        self.weights = np.array(weights, np.float32).reshape(len(weights), BUCKETS).T.copy()
        self.trust = np.ones(self.code.shape[1])

    def margins(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per document and bit: the mean log ratio, grown with the root of the length."""
        n = np.diff(first)
        out = np.zeros((len(n), self.weights.shape[1]))
        filled = np.flatnonzero(n)
        if len(filled):
            out[filled] = np.add.reduceat(self.weights[buckets], first[:-1][filled], axis=0)
        return out / np.sqrt(np.maximum(n, 1))[:, None]

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Per document and language: the weighted logistic loss of its codeword."""
        return np.stack([(np.logaddexp(0, -margins * word) * self.trust).sum(1) for word in self.code], 1)


def even_share(sizes: list[int], total: int) -> float:
    """Rows of each language at most, so that the sample has ``total`` rows (or all there are)."""
    left = total
    for k, size in enumerate(sorted(sizes)):
        each = left / (len(sizes) - k)
        if size > each:
            return each
        left -= size
    return float(max(sizes, default=0))


def learn(rows: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """``rows``: doc_id, text, lang; ``train``: a condition on doc_id."""
    known = rows.where("lang is not null and text is not null").where(train)
    sizes = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("size")))  # one small row per language
    most = max(even_share([r["size"] for r in sizes.select("size").collect()], sample_rows), LEAST_ROWS)
    parts = 1 << 40
    shares = sizes.select("lang", F.ceil(F.least(F.lit(1.0), F.lit(float(most)) / F.col("size")) * parts).alias("share"))
    # Dealt by id: equal texts and a common language are spread.
    sample = stored(known.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < F.col("share"))
                    .repartition(SAMPLE_TASKS, "doc_id").select("text", "lang"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in T.chunks(batches):
            buckets, first, _ = grams(T.whole(batch))
            for d, lang in enumerate(T.column(batch, "lang").to_pylist()):
                own = np.bincount(buckets[first[d]:first[d + 1]], minlength=BUCKETS)
                # A long document counts as its root, so that no single text rules its language.
                sums[lang] = sums.get(lang, 0) + own / math.sqrt(max(1, own.sum()))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                                         ["lang", "sums"])

    # At most a row per sample file (a bounded sample) and language.
    sums: dict[str, np.ndarray] = {}
    for row in sample.mapInArrow(count, "lang string, sums binary").collect():
        sums[row["lang"]] = sums.get(row["lang"], 0) + np.frombuffer(row["sums"])
    languages = sorted(sums)
    model = Model(languages, np.array([sums[k] for k in languages]).reshape(len(languages), BUCKETS))

    def judge(batches):
        right, seen = np.zeros(model.code.shape[1]), 0
        for batch in T.chunks(batches):
            buckets, first, _ = grams(T.whole(batch))
            word = model.code[[languages.index(x) for x in T.column(batch, "lang").to_pylist()]]
            right += (model.margins(buckets, first) * word > 0).sum(0)
            seen += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([right.tolist()], pa.list_(pa.float64())), pa.array([seen])], ["right", "seen"])

    if len(languages) > 1:
        judged = sample.mapInArrow(judge, "right array<double>, seen bigint").collect()
        accuracy = (np.sum([r["right"] for r in judged], 0) + 1) / (sum(r["seen"] for r in judged) + 2)
        model.trust = np.log(np.clip(accuracy, 0.51, 1 - 1e-6) / (1 - np.clip(accuracy, 0.51, 1 - 1e-6)))
        model.trust /= model.trust.mean()
    return model


def identify(documents: DataFrame, train: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), ambiguous of every row.

    ``train``: a condition on doc_id that marks the rows whose language may be
    learned; by default those with crc32(id) mod 5 other than 0.
    """
    if train is None:
        train = fold(F.col("doc_id"), 5) != 0
    labelled = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                                F.col(lang_col).cast("string").alias("lang"))
    model = learn(labelled, train, sample_rows)

    def run(batches):
        for batch in T.chunks(batches):
            texts = T.whole(batch)
            buckets, first, letters = grams(texts)
            n = batch.num_rows
            names, score, unsure = np.full(n, "und", object), np.zeros(n), np.zeros(n, bool)
            some = letters > 0
            # Without an ASCII letter, look for one beyond: other bytes may be signs or digits.
            plain = T.utf8(texts)
            for d in np.flatnonzero(some).tolist():
                own = plain[0][plain[1][d]:plain[1][d + 1]]
                if not ((own | 0x20) - 97 < 26).any():
                    some[d] = any(c.isalpha() for c in texts[d].as_py())
            if model.languages:
                losses = model.losses(model.margins(buckets, first))
                order = np.argsort(losses, axis=1, kind="stable")
                best = losses[np.arange(n), order[:, 0]]
                weight = np.exp(np.clip(best[:, None] - losses, -700, 0))
                names[some] = np.array(model.languages, object)[order[some, 0]]
                score[some] = (1 / weight.sum(1))[some]
                if len(model.languages) > 1:
                    unsure = some & (losses[np.arange(n), order[:, 1]] - best < AMBIGUOUS)
            yield pa.RecordBatch.from_arrays([T.column(batch, "doc_id"), pa.array(names.tolist(), pa.string()),
                                              pa.array(score), pa.array(unsure)], ["doc_id", "lang_pred", "score", "ambiguous"])

    return keyed(documents, id_col, text_col, False).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, ambiguous boolean")
