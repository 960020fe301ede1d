"""Toxic passages as maximum-scoring segments of token log-odds.

Learning uses a bounded sample of labelled documents (``sample_rows``, chosen by
a hash of the id), of which near copies with the same label count once, by the
least id (documents that share a least word-triple hash), so that no toxic row
goes for a clean one like it.  A token's evidence is the log-odds ratio of its document
frequency in toxic and other documents under a symmetric Dirichlet prior, less
its standard error, if the difference is significant; a token is known by itself
or by a prefix, so inflected and compound forms share evidence.  All other tokens
cost a small drift, so that a random text scores below zero.

A linear-time scan finds every maximal scoring segment of a document.  Segment
scores are calibrated as extreme values: for scores with negative mean, the best
segment of n random tokens exceeds S with E = K n exp(-lambda S), lambda from the
token scores of clean documents.  Segments with E below ``significance`` are the
reported passages; a logistic curve on the best segment's log E, fitted on the
sample, gives the document's score.

Defined results: null and empty texts have no tokens and score as a text without
evidence; labels with null id or label are left out, repeated labels of an id
count once (the larger); without labels of both kinds every score is 0; repeated
rows are scored one by one; other columns are ignored, or returned inside ``row``
with ``carry``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from wiretable.llm import tokens as T
from wiretable.llm.frames import fold, keyed, stored

SAMPLE_ROWS = 20_000
TOKENS = 20_000
PRIOR = 0.5
CAUTION = 1.0
#: Least likelihood-ratio statistic of a token (chi-square, one degree): p = 8e-6, as very many tokens are tried.
LEAST_G2 = 20.0
DRIFT = 0.1
K = 0.1
SIGNIFICANCE = 0.01
#: A token is looked up by itself and by its first bytes.
PREFIXES = (4, 5, 6)
PASSAGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def features(words: T.Words) -> list[np.ndarray]:
    """Keys of every token: the token, and its prefixes (0 where it is no longer than the prefix)."""
    lens = words.ends - words.starts
    out = [T.hash_spans(words.data, words.starts, lens)]
    for size in PREFIXES:
        keys = np.zeros(len(lens), np.uint64)
        long = np.flatnonzero(lens > size)
        keys[long] = T.hash_spans(words.data, words.starts[long], np.full(len(long), size)) ^ np.uint64(size)
        out.append(keys)
    return out


def token_scores(words: T.Words, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The strongest evidence of each token, less the drift; ``keys`` are sorted."""
    best = np.zeros(len(words.starts))
    if len(keys):
        for own in features(words):
            at = np.searchsorted(keys, own)
            at[at == len(keys)] = 0
            found = np.where(keys[at] == own, weights[at], 0.0)
            best = np.where(np.abs(found) > np.abs(best), found, best)
    return best - DRIFT


def best_segments(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The largest segment sum of each document (0 if none is positive)."""
    counts = np.diff(first)
    out = np.zeros(len(counts))
    if not len(scores):
        return out
    doc = np.repeat(np.arange(len(counts)), counts)
    total = np.cumsum(scores)
    # Documents are set apart by more than any sum, so a running minimum begins anew with each.
    apart = 2 * np.abs(scores).sum() + 1
    after = total - doc * apart
    before = after - scores
    low = np.minimum.accumulate(before)
    filled = np.flatnonzero(counts)
    out[filled] = np.maximum(np.maximum.reduceat(after - low, first[:-1][filled]), 0)
    return out


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum) in one pass over the scores."""
    kept: list[list[float]] = []  # start, end, sum before, sum after
    total = 0.0
    for at, score in enumerate(scores):
        if score <= 0:
            total += score
            continue
        segment = [at, at + 1, total, total + score]
        total += score
        while kept:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= segment[2]:
                j -= 1
            if j < 0 or kept[j][3] >= segment[3]:
                break
            segment = [kept[j][0], segment[1], kept[j][2], segment[3]]
            del kept[j:]
        kept.append(segment)
    return [(int(a), int(b), right - left) for a, b, left, right in kept]


def decay(values: np.ndarray, counts: np.ndarray) -> float:
    """lambda > 0 with mean exp(lambda score) = 1 over the clean tokens' scores."""
    share = counts / counts.sum()
    if not (values > 0).any() or (values * share).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (share * np.exp(np.minimum(high * values, 700))).sum() < 1:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        if (share * np.exp(np.minimum(mid * values, 700))).sum() < 1:
            low = mid
        else:
            high = mid
    return max(high, 1e-6)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps, with a weak normal prior on the slope."""
    shift, scale = x.mean(), max(x.std(), 1e-9)
    z = (x - shift) / scale
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * z, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([(y - p).sum() - 1e-3 * a, ((y - p) * z).sum() - 1e-1 * b])
        h = np.array([[w.sum() + 1e-3, (w * z).sum()], [(w * z).sum(), (w * z * z).sum() + 1e-1]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -2, 2)), b + float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-9:
            break
    return a - b * shift / scale, b / scale


class Model:
    """Sorted token keys and weights, decay and calibration."""

    def __init__(self, keys, weights, lam=1.0, curve=None):
        self.keys, self.weights, self.lam, self.curve = keys, weights, lam, curve

    def log_e(self, best: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.log(K * np.maximum(n, 1)) - self.lam * best

    def probability(self, best: np.ndarray, n: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(best))
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a - b * self.log_e(best, n), -500, 500)))


def learn(documents: DataFrame, labels: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """``documents``: doc_id, text; ``labels``: doc_id, label; ``train``: a condition on doc_id."""
    known = labels.where("doc_id is not null and label is not null").where(train).groupBy("doc_id").agg(
        F.max("label").alias("label"))
    n = known.count()
    if not n:
        return Model(np.zeros(0, np.uint64), np.zeros(0))
    parts = 1 << 20
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < math.ceil(min(1.0, sample_rows / n) * parts))
    # About sample_rows rows of two numbers: broadcast.
    sample = stored(documents.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("label").cast("int").alias("label")))

    def sketches(batches):
        for batch in T.chunks(batches):
            words = T.find_words(T.whole(batch), T.ALNUM, lower=True)
            hashes = words.hashes()
            ends = words.first[1:]
            out = []
            for seed in (1, 2):
                gram = T.grams(np.append(hashes, np.zeros(2, np.uint64)), 3, seed)
                # A text below three words is known by its first words; the others by their least triple.
                least = [gram[a:max(a + 1, b - 2)].min(initial=np.uint64(2 ** 64 - 1)) if b > a else np.uint64(0)
                         for a, b in zip(words.first[:-1].tolist(), ends.tolist())]
                out.append(pa.array(np.array(least, np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays([T.column(batch, k) for k in ("doc_id", "text", "label")] + out, ["doc_id", "text", "label", "one", "two"])

    # The least row of each label and sketch: the same rows in every run, however the tasks come.
    distinct = sample.mapInArrow(sketches, "doc_id bigint, text string, label int, one bigint, two bigint")
    for sketch in ("one", "two"):
        distinct = distinct.groupBy("label", sketch).agg(F.min(F.struct("doc_id", "text", *["two"] * (sketch == "one"))).alias("least")).select(
            "label", "least.*")
    distinct = stored(distinct.select("text", "label"))
    sizes = {r["label"]: r["n"] for r in distinct.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model(np.zeros(0, np.uint64), np.zeros(0))

    def presence(batches):
        for batch in T.chunks(batches):
            words = T.find_words(T.whole(batch), T.ALNUM, lower=True)
            label = T.column(batch, "label").to_numpy()[words.doc_of()]
            doc = words.doc_of().astype(np.uint64)
            key = np.concatenate(features(words))
            pair = np.unique(np.stack([key, np.tile(doc, 1 + len(PREFIXES)), np.tile(label.astype(np.uint64), 1 + len(PREFIXES))], 1)[key > 0], axis=0)
            keys, place = np.unique(pair[:, 0], return_inverse=True)
            y1 = np.bincount(place, pair[:, 2].astype(np.float64), len(keys)).astype(np.int64)
            y = np.bincount(place, minlength=len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(y1), pa.array(y - y1)], ["key", "y1", "y0"])

    seen = distinct.mapInArrow(presence, "key bigint, y1 bigint, y0 bigint").groupBy("key").agg(
        F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
    odds = lambda y, n: F.log((y + PRIOR) / (F.lit(n) - y + PRIOR))
    ratio = odds(F.col("y1"), n1) - odds(F.col("y0"), n0)
    spread = CAUTION * F.sqrt(1 / (F.col("y1") + PRIOR) + 1 / (F.col("y0") + PRIOR))
    cautious = F.when(ratio > spread, ratio - spread).when(ratio < -spread, ratio + spread)
    total = F.col("y1") + F.col("y0")

    def part(y, share):
        return F.when(y > 0, y * F.log(y / (total * share))).otherwise(0.0)

    share = n1 / (n1 + n0)
    g2 = 2 * (part(F.col("y1"), share) + part(F.col("y0"), 1 - share))
    rows = (seen.where(g2 >= LEAST_G2).select("key", cautious.alias("w")).where("w is not null")
            .orderBy(F.abs("w").desc(), "key").limit(TOKENS).collect())
    keys = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    model = Model(keys[order], np.array([r["w"] for r in rows], np.float64)[order])

    def evidence(batches):
        for batch in T.chunks(batches):
            words = T.find_words(T.whole(batch), T.ALNUM, lower=True)
            scores = token_scores(words, model.keys, model.weights)
            values = [np.unique(np.round(scores[a:b], 3), return_counts=True) for a, b in zip(words.first[:-1], words.first[1:])]
            yield pa.RecordBatch.from_arrays([
                pa.array(best_segments(scores, words.first)), pa.array(words.counts, pa.int64()), T.column(batch, "label"),
                pa.array([v.tolist() for v, _ in values], pa.list_(pa.float64())),
                pa.array([c.tolist() for _, c in values], pa.list_(pa.int64()))], ["best", "n", "label", "value", "count"])

    measured = stored(distinct.select("text", "label").mapInArrow(
        evidence, "best double, n bigint, label int, value array<double>, count array<bigint>"))
    # Bounded by the sample: a row per sampled document, and one per rounded score.
    tokens = (measured.where("label = 0").select(F.inline(F.arrays_zip("value", "count")))
              .groupBy("value").agg(F.sum("count").alias("count")).collect())
    # Sorted, as sums of floats depend on their order.
    tokens.sort(key=lambda r: r["value"])
    values = np.array([r["value"] for r in tokens] + [float(model.weights.max(initial=1.0))])
    model.lam = decay(values, np.array([r["count"] for r in tokens] + [0.5], np.float64))
    points = sorted(measured.select("best", "n", "label").collect())
    best, n, label = (np.array([r[k] for r in points], np.float64) for k in ("best", "n", "label"))
    intercept, slope = logistic(-model.log_e(best, n), label)
    model.curve = (intercept, slope)
    return model


def score_toxicity(documents: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS,
                   significance: float = SIGNIFICANCE, carry: bool = False) -> DataFrame:
    """doc_id, score (0 to 1), passages (start, end in words, score) of every row.

    ``train``: a condition on doc_id that marks the rows whose labels may be
    learned; by default those with crc32(id) mod 5 other than 0.
    """
    marks = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).alias("label"))
    if train is None:
        train = fold(F.col("doc_id"), 5) != 0
    model = learn(keyed(documents, id_col, text_col, False), marks, train, sample_rows)
    rows = keyed(documents, id_col, text_col, carry)
    kept = [n for n in rows.columns if n != "text"]
    passage = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("score", DoubleType())])
    schema = StructType([rows.schema[n] for n in kept] + [StructField("score", DoubleType()), StructField("passages", ArrayType(passage))])

    def run(batches):
        for batch in T.chunks(batches):
            words = T.find_words(T.whole(batch), T.ALNUM, lower=True)
            scores = token_scores(words, model.keys, model.weights)
            best, n = best_segments(scores, words.first), words.counts
            passages: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            limit = math.log(significance)
            for d in np.flatnonzero((best > 0) & (model.log_e(best, n) < limit)).tolist():
                need = (math.log(K * max(int(n[d]), 1)) - limit) / model.lam
                passages[d] = [{"start": a, "end": b, "score": s}
                               for a, b, s in maximal_segments(scores[words.first[d]:words.first[d + 1]].tolist()) if s > need]
            yield pa.RecordBatch.from_arrays([T.column(batch, k) for k in kept] + [
                pa.array(model.probability(best, n)), pa.array(passages, PASSAGES)], schema.names)

    return rows.mapInArrow(run, schema)
