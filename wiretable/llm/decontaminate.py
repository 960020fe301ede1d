"""Benchmark decontamination: an FM-index per training shard, searched backward.

A shard is a chunk of whole documents inside a scan task.  Words that occur in
no test phrase are one separator symbol (no match can cross them), and passages
too short for the shortest phrase are left out; the rest is indexed, every test
phrase is searched backward through the wavelet-tree ranks, occurrences are
located by the sampled suffix places and the hit words merged into spans.

Documents are neither shuffled nor joined: the test phrases are the stated query
set, sent to the tasks in blocks of at most ``block_bytes`` of text (a checked
bound; a larger benchmark takes several passes, joined by a row number).

Defined results: null or empty texts have no words and no hits; items without
words are ignored; equal items count as several items; an item without an id hits
like any other and is not listed; repeated documents are
judged one by one; an empty benchmark hits nothing; other columns are ignored,
or returned inside ``row`` with ``carry``.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wiretable.llm import tokens as T
from wiretable.llm.fm_index import FMIndex
from wiretable.llm.frames import keyed, stored

WINDOW = 10
BLOCK_BYTES = 8 << 20
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SPAN_TYPE = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
BASE = ("n_words", "n_hit", "spans", "items")


class Phrases:
    """The windows of a block of test items, as word hashes."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.names = [name for name, _ in items]
        words = T.find_words(pa.array([text for _, text in items], pa.string()), T.ALNUM, lower=True)
        hashes = words.hashes()
        self.vocabulary, ids = np.unique(hashes, return_inverse=True)
        owners: dict[bytes, set[int]] = defaultdict(set)
        for d, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
            size = min(window, b - a)
            for at in range(a, b - size + 1) if size else ():
                owners[ids[at:at + size].astype(np.int64).tobytes()].add(d)
        parts = [np.frombuffer(k, np.int64) for k in owners]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.symbols = np.concatenate(parts) + 1 if parts else np.zeros(0, np.int64)
        self.owners = [sorted(v) for v in owners.values()]


def find_phrases(words: T.Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrase, first word and end of each occurrence in a shard."""
    none = np.zeros(0, np.int64)
    if not len(words.starts) or not len(phrases.sizes):
        return none, none, none
    hashes = words.hashes()
    at = np.searchsorted(phrases.vocabulary, hashes)
    at[at == len(phrases.vocabulary)] = 0
    ids = np.where(phrases.vocabulary[at] == hashes, at + 1, 0)
    # A zero before each document keeps passages inside documents.
    heads = words.first[:-1][words.counts > 0]
    text = np.insert(np.append(ids, 0), heads, 0)
    place = np.insert(np.append(np.arange(len(ids)), -1), heads, -1)
    begins, stops = T.runs(text > 0)
    long = stops - begins >= phrases.sizes.min()
    begins, sizes = begins[long], (stops - begins)[long] + 1  # with the separator behind
    if not len(begins):
        return none, none, none
    take = T.ranges(begins, sizes)
    text, place = text[take], place[take]
    index = FMIndex(text, len(phrases.vocabulary) + 1).compress()
    low, high = index.search(phrases.symbols, phrases.ends, phrases.sizes)
    found = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(found)), found)
    first = place[index.locate(T.ranges(low, found))]
    return which, first, first + phrases.sizes[which]


def _describe(batch: pa.RecordBatch, hit_of, with_text: bool) -> tuple[list[pa.Array], T.Words]:
    """n_words, n_hit, spans and clean_text of a chunk; ``hit_of(words)`` flags the hit words."""
    words = T.find_words(T.whole(batch), T.ALNUM, lower=True)
    hit = hit_of(words)
    edges = np.concatenate([[0], np.cumsum(hit)])
    n_hit = edges[words.first[1:]] - edges[words.first[:-1]]
    spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
    if with_text:
        clean = T.whole(batch).to_pylist()
        original = T.find_words(T.whole(batch), T.ALNUM) if n_hit.any() else words
        original = T.Words(original.data, words.docs, words.starts, words.ends, words.first)
    for d in np.flatnonzero(n_hit).tolist():
        begins, stops = T.runs(hit[words.first[d]:words.first[d + 1]])
        spans[d] = [{"start": int(x), "end": int(y)} for x, y in zip(begins, stops)]
        if with_text:
            clean[d] = T.cut(original, d, begins, stops)
    return [pa.array(words.counts, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, SPANS)] + (
        [pa.array(clean, pa.string())] if with_text else []), words


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  block_bytes: int = BLOCK_BYTES, with_text: bool = False, carry: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, spans of hit words [start, end), items (sorted ids).

    ``with_text`` adds clean_text, the text without the hit spans; ``carry``
    the whole input row as ``row``.
    """
    docs = keyed(documents, id_col, text_col, carry)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.coalesce(F.col(item_text), F.lit("")).alias("body"))
    size = items.agg(F.sum(F.octet_length("body") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    kept = [n for n in docs.columns if n != "text"]
    schema = StructType([docs.schema[n] for n in kept] + [
        StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("spans", SPAN_TYPE)]
        + [StructField("clean_text", StringType())] * with_text + [StructField("items", ArrayType(StringType()))])

    def passed(block: int, source: DataFrame, kept: list[str], schema: StructType, text_out: bool) -> DataFrame:
        # One block of the stated query set; its text is bounded by block_bytes.
        rows = items.where(F.pmod(F.xxhash64(F.coalesce("item", "body")), F.lit(blocks)) == block).collect()
        phrases = Phrases([(r["item"], r["body"]) for r in rows], window)

        def search(batches):
            for batch in T.chunks(batches):
                found = []

                def hit_of(words):
                    found.extend(find_phrases(words, phrases))
                    return T.covered(len(words.starts), found[1], found[2])

                out, words = _describe(batch, hit_of, text_out)
                owner = np.searchsorted(words.first, found[1], "right") - 1
                named: dict[int, set[int]] = defaultdict(set)
                for doc, phrase in np.unique(np.stack([owner, found[0]], 1), axis=0).tolist():
                    named[doc].update(phrases.owners[phrase])
                out.append(pa.array([sorted(phrases.names[i] for i in named.get(d, ()) if phrases.names[i] is not None)
                                     for d in range(batch.num_rows)],
                                    pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays([T.column(batch, n) for n in kept] + out, schema.names)

        return source.mapInArrow(search, schema)

    if blocks == 1:
        return passed(0, docs, kept, schema, with_text)
    numbered = stored(docs.withColumn("place", F.monotonically_increasing_id()))
    narrow = StructType([StructField("place", LongType()), *[f for f in schema.fields if f.name in BASE]])
    found = [passed(block, numbered.select("place", "text"), ["place"], narrow, False).where("n_hit > 0")
             for block in range(blocks)]
    merged = reduce(DataFrame.unionByName, found).groupBy("place").agg(
        F.sort_array(F.flatten(F.collect_list("items"))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"))

    def finish(batches):
        for batch in T.chunks(batches):
            spans = T.column(batch, "spans").to_pylist()

            def hit_of(words):
                own = [(a + s["start"], a + s["end"]) for a, each in zip(words.first.tolist(), spans) for s in each or ()]
                starts, ends = np.array(own, np.int64).reshape(-1, 2).T
                return T.covered(len(words.starts), starts, ends)

            out, _ = _describe(batch, hit_of, with_text)
            yield pa.RecordBatch.from_arrays([T.column(batch, n) for n in kept] + out + [T.column(batch, "items")],
                                             schema.names)

    joined = numbered.join(merged, "place", "left").drop("place")
    return joined.withColumn("items", F.coalesce("items", F.array().cast("array<string>"))).mapInArrow(finish, schema)
