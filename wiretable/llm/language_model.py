"""Language-model scoring with a weighted backoff automaton.

Training counts cover every training document and grow with the corpus, so no
task holds the model.  Documents are packed into blocks of bounded size; a block
asks for the counts of its own distinct n-grams only: sorted key arrays, cut by
key range, go to the range's reducer, which adds up the training counts of all
blocks and answers each block with the totals in the order of its request
(answers carry no keys).  Each block then builds the part of the automaton that
its documents can reach: one state per context, arcs for seen bigrams, and a
failure arc to the empty context that carries the backoff weight.  Documents
are read left to right, carrying the state and adding log10 probabilities.

Smoothing: P(w) = (c(w) + 1) / (N + V + 1); P(w | h) = (c(hw) + mu P(w)) / (c(h) + mu),
which is a distribution, with backoff weight mu / (c(h) + mu) for unseen hw.

Words and bigrams are known by 62-bit hashes.  Defined results: null and empty
texts are one end token; without training documents every token has probability
1; repeated rows are counted and scored one by one; a null id is in fold 0;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretable.llm import blocks as B
from wiretable.llm import tokens as T
from wiretable.llm.corpus_sums import ASKED, FAN_IN, corpus_values, requests
from wiretable.llm.frames import fold, keyed, stored

MU = 500.0
BLOCK_BYTES = 3 << 20
RANGE_BYTES = 16 << 20
#: Tokens that one lane of the traversal reads; a lane starts with the token before its first.
LANE = 256

END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
_KIND = np.uint64(3)


class BlockText:
    """Tokens of a block and its distinct n-gram keys (unigrams and bigrams), sorted."""

    def __init__(self, texts: pa.Array):
        words = T.find_words(texts, lower=True)
        self.counts = words.counts + 1
        ends = np.cumsum(self.counts) - 1
        self.first = ends - words.counts
        token = np.empty(int(self.counts.sum()), np.uint64)
        inside = np.ones(len(token), bool)
        inside[ends] = False
        token[inside] = words.hashes()
        token[ends] = END
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[self.first] = START
        one = token & ~_KIND | np.uint64(1)
        two = T.mix(before * np.uint64(0x9E3779B97F4A7C15) + token) & ~_KIND | np.uint64(2)
        self.keys, place = np.unique(np.concatenate([one, two]), return_inverse=True)
        self.one, self.two = place[:len(one)], place[len(one):]

    def trained(self, train: np.ndarray) -> np.ndarray:
        """How often each key stands in the training documents of the block."""
        weight = np.repeat(train.astype(np.float64), self.counts)
        return (np.bincount(self.one, weight, len(self.keys)) + np.bincount(self.two, weight, len(self.keys))).astype(np.int64)


class Automaton:
    """States: 0 empty context, 1 + w the context of word w, and the start of a text.

    ``arcs`` are the sorted keys state * words + word of the seen bigrams.  The
    empty context has an arc for every word of the block, so every failure ends.
    """

    def __init__(self, keys: np.ndarray, weights: np.ndarray, fail: np.ndarray, known: np.ndarray, unigram: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[order]
        self.fail, self.unigram = fail, unigram
        self.after = np.where(known, np.arange(len(unigram)) + 1, 0)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next state and log10 weight of reading a word."""
        key = state * len(self.unigram) + word
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        seen = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
        # Without an arc the failure arc leads to the empty context, which reads every word.
        weight = np.where(seen, self.weights[at] if len(self.keys) else 0.0, self.fail[state] + self.unigram[word])
        return self.after[word], weight


def read_lanes(automaton: Automaton, word: np.ndarray, first: np.ndarray, counts: np.ndarray, start: int) -> np.ndarray:
    """Sum of weights per text, read left to right.

    Long texts are read by several lanes: the state after a token depends on
    that token alone, so a lane takes its state from the token before it.
    """
    pieces = -(-counts // LANE)
    owner = np.repeat(np.arange(len(counts)), pieces)
    offset = T.ranges(np.zeros(len(counts), np.int64), pieces) * LANE
    at = first[owner] + offset
    left = np.minimum(counts[owner] - offset, LANE)
    order = np.argsort(-left, kind="stable")
    at, left, owner, offset = at[order], left[order], owner[order], offset[order]
    state = np.where(offset == 0, start, automaton.after[word[np.maximum(at - 1, 0)]])
    total = np.zeros(len(at))
    for k in range(int(left.max(initial=0))):
        live = int(np.searchsorted(-left, -k, "left"))  # lanes with more than k tokens come first
        state[:live], weight = automaton.step(state[:live], word[at[:live] + k])
        total[:live] += weight
    return np.bincount(owner, total, len(counts))


def _score(block: BlockText, totals: np.ndarray, tokens: int, types: int, mu: float) -> list[pa.Array]:
    is_word = (block.keys & _KIND) == 1
    ids = np.cumsum(is_word) - 1
    word = ids[block.one]
    c = totals[is_word].astype(np.float64)
    unigram = np.log10((c + 1) / (tokens + types + 1))
    n, start = len(c), len(c) + 1
    # A context has as many followers as tokens; the start has as many as there are ends.
    end = word[block.first + block.counts - 1][0]
    followers = np.concatenate([[0.0], c, [c[end]]])
    fail = np.log10(mu / (followers + mu))
    fail[0] = 0.0
    before = np.empty(len(word), np.int64)
    before[1:] = word[:-1] + 1
    before[block.first] = start
    seen, place = np.unique(block.two, return_index=True)
    seen, place = seen[totals[seen] > 0], place[totals[seen] > 0]
    state, read = before[place], word[place]
    weights = np.log10((totals[seen] + mu * 10 ** unigram[read]) / (followers[state] + mu))
    automaton = Automaton(state * n + read, weights, fail, c > 0, unigram)
    score = read_lanes(automaton, word, block.first, block.counts, start)
    known = np.add.reduceat((c > 0)[word].astype(np.int64), block.first)
    base = np.add.reduceat(unigram[word], block.first)
    return [pa.array(block.counts, pa.int64()), pa.array(known, pa.int64()),
            pa.array(np.full(len(base), tokens), pa.int64()), pa.array(base), pa.array(score)]


def score_documents(documents: DataFrame, held_out: Column | None = None, mu: float = MU, id_col: str = "doc_id",
                    text_col: str = "text", block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES,
                    fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``held_out`` (a condition on the input's columns) marks the documents that
    are not learned from; by default those with crc32(id) mod 7 = 2.
    """
    held = held_out if held_out is not None else fold(F.col(id_col), 7) == 2
    rows = keyed(documents.withColumn("row_held", F.coalesce(held, F.lit(False))), id_col, text_col, True).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("row.row_held").alias("held_out"))
    packed = B.in_blocks(rows, limit=block_bytes)
    seen = packed.agg(F.sum("n_bytes").alias("size"), F.count(F.lit(1)).alias("blocks")).first()
    width = B.ranges_for(seen["size"] or 0, range_bytes)
    packed = packed.select("block", "payload")

    def request(batches):
        for batch in batches:
            for name, payload in zip(T.column(batch, "block").to_pylist(), T.column(batch, "payload").to_pylist()):
                table = B.rows_of(payload)
                block = BlockText(table.column("text").combine_chunks())
                counts = block.trained(~table.column("held_out").to_numpy())
                pa.default_memory_pool().release_unused()
                yield requests(name, block.keys, counts, width)

    replies = stored(corpus_values(packed.mapInArrow(request, ASKED), seen["blocks"], lambda keys, total: total,
                                   lambda keys: (keys & _KIND) == 1, fan_in))
    stats = replies.agg(F.sum("n").alias("n"), F.sum("kinds").alias("v")).first()
    tokens, types = int(stats["n"] or 0), int(stats["v"] or 0)

    def finish(rows: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("part")
        totals = np.concatenate([B.unpack(x.as_py()) for x in answers.column("values")])
        out = []
        for payload in rows.column("payload").to_pylist():
            table = B.rows_of(payload)
            block = BlockText(table.column("text").combine_chunks())
            if len(totals) != len(block.keys):
                raise ValueError("the counts do not fit the block's n-grams")
            names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
            out.append(pa.table({"doc_id": table.column("doc_id"), "held_out": table.column("held_out"),
                                 **dict(zip(names, _score(block, totals, tokens, types, mu)))}))
        return pa.concat_tables(out)

    return packed.groupBy("block").cogroup(replies.select("block", "part", "values").groupBy("block")).applyInArrow(
        finish, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                "base_score double, score double")
