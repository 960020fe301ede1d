"""Spelling variants: words one edit apart, by an index of variable-length grams.

1. Words are counted over all documents; each task adds up what it reads.
2. The gram dictionary is grown from the words: a gram that stands at more than
   1 / ``frequent`` of all places of its length is too frequent to tell words apart
   and is extended by the next letter, up to ``longest`` letters.  At most
   ``frequent`` grams of a length can be that frequent, which bounds the dictionary.
3. A word, with a mark at each end, is decomposed into one gram per place: the
   shortest that the dictionary does not extend.  Whether a gram is taken depends on
   its own letters alone, so an edit affects only the grams that it lies in.  The
   largest number of grams that any one edit lies in is the word's bound: a word one
   edit away keeps all others, in their order, at the same distance from the start
   (grams left of the edit) or from the end (grams right of it).
4. So of the ``bound + 1`` rarest grams of two near words one is common, at an equal
   distance from an end.  A word is listed under these, by gram and distance.  Lists
   are sorted runs in their partitions; a run is merged by comparing its words with
   those behind it (lengths at most one apart), each pair verified letter by letter.
   Only near words leave a task.
5. A list of more than ``list_limit`` words is split exactly: its words have one
   gram in common, so those whose bound leaves a second are listed again under two
   grams, and so on.  Words whose bound leaves none stay together; they differ from
   the list's grams in a few letters only.

Forms are the near words of largest count and are followed to their roots by
pointer doubling; counts at least double at each step, so chains are short.

Defined results: null and empty texts have no words; a null doc_id counts as an empty
one; ties of count go to the smaller word in code-point order; repeated rows count
each; an empty table gives an empty result; other columns are ignored.  Runs are
of letters up to U+00FF, a byte each in Latin-1.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretable.llm import tokens as T
from wiretable.llm.frames import keyed, stored, stored_with

RUN = "[A-Za-zÀ-ÿ]+"
UPPER = {c: c + 32 for c in range(0x41, 0x5B)}
#: One in ``DAMAGED`` distinct runs of a document loses a letter.
DAMAGED = 97
SHORTEST_WORD = 5
LEAST_COUNT = 3
SHORTEST = 2
LONGEST = 5
FREQUENT = 2000
LIST_LIMIT = 2000
#: Distinct entries that a task adds up before it passes them on.
HELD = 300_000
#: Pairs that are verified at once.
PAIRS = 1 << 20
HEAD, TAIL = "^", "$"


def flushed(counts: Counter, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names)


def count_words(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST_WORD,
                least: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words with enough letters and occurrences."""
    def run(batches):
        find = re.compile(RUN).findall
        counts: Counter = Counter()
        for batch in T.chunks(batches):
            for name, text in zip(T.column(batch, "doc_id").to_pylist(), T.column(batch, "text").to_pylist()):
                if text:
                    prefix = zlib.crc32(f"{'' if name is None else name}:".encode())
                    for word, n in Counter(find(text.translate(UPPER))).items():
                        h = zlib.crc32(word.encode(), prefix)
                        if not h % DAMAGED:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                        if len(word) >= shortest:
                            counts[word] += n
            if len(counts) > HELD:
                yield flushed(counts, ["word", "n"])
                counts = Counter()
        if counts:
            yield flushed(counts, ["word", "n"])

    found = keyed(documents, id_col, text_col, False).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def count_grams(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """gram, n: at how many places of the marked words each gram of 2 to ``longest`` letters stands."""
    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for word in T.column(batch, "word").to_pylist():
                marked = HEAD + word + TAIL
                for size in range(SHORTEST, longest + 1):
                    counts.update(marked[p:p + size] for p in range(len(marked) - size + 1))
                if len(counts) > HELD:
                    yield flushed(counts, ["gram", "n"])
                    counts = Counter()
        if counts:
            yield flushed(counts, ["gram", "n"])

    return words.select("word").mapInArrow(run, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


class Grams:
    """The dictionary: grams that are extended, and how often the others stand in words."""

    def __init__(self, extended: set[str], often: dict[str, int], longest: int = LONGEST):
        self.extended, self.often, self.longest = extended, often, longest

    def decompose(self, marked: str) -> list[str]:
        """The gram of each place."""
        out, n = [], len(marked)
        for p in range(n - SHORTEST + 1):
            end = p + SHORTEST
            while marked[p:end] in self.extended and end < n:
                end += 1
            out.append(marked[p:end])
        return out

    @staticmethod
    def bound(grams: list[str]) -> int:
        """The most grams that one letter of the word, or one gap between letters, lies in."""
        n = len(grams) + SHORTEST - 1
        depth = [0] * (n + 1)
        for p, g in enumerate(grams):
            depth[p] += 1
            depth[p + len(g)] -= 1
        most = now = 0
        for i in range(n - 1):  # the mark at the end is never edited
            now += depth[i]
            most = max(most, now) if i else most
        return most

    def listed(self, word: str, used: list[int]) -> tuple[list[tuple[int, str]], int]:
        """(place, list) of the word's rarest unused grams, twice each (from the start and the end), and how many
        grams every near word keeps."""
        marked = HEAD + word + TAIL
        grams = self.decompose(marked)
        bound = self.bound(grams)
        free = [p for p in range(len(grams)) if p not in used]
        free.sort(key=lambda p: (self.often.get(grams[p], 0), grams[p], p))
        keys = []
        for p in free[:bound + 1]:
            keys.append((p, f"{grams[p]}<{p}"))
            keys.append((p, f"{grams[p]}>{len(marked) - p}"))
        return keys, len(grams) - bound


def gram_dictionary(words: DataFrame, frequent: int = FREQUENT, longest: int = LONGEST) -> Grams:
    """Grown from at most ``frequent`` grams of a length and their extensions by one letter (the driver's bound)."""
    grams = stored(count_grams(words, longest).withColumn("size", F.length("gram")))
    places = {r["size"]: r["n"] for r in grams.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    often = F.lit(False)
    for size in range(SHORTEST, longest):
        often |= (F.col("size") == size) & (F.col("n") * frequent > places.get(size, 0)) & ~F.endswith("gram", F.lit(TAIL))
    extended = grams.where(often).select("gram")
    leaves = grams.where(~often).withColumn("parent", F.expr("left(gram, size - 1)"))
    below = leaves.join(F.broadcast(extended.withColumnRenamed("gram", "parent")), "parent", "left_semi")
    leaves = leaves.where(F.col("size") == SHORTEST).unionByName(below.select(leaves.columns))
    return Grams({r["gram"] for r in extended.collect()}, {r["gram"]: r["n"] for r in leaves.select("gram", "n").collect()}, longest)


LISTED = "key bigint, word string, n bigint, used array<int>, final boolean"


def list_key(text: str, from_end: bool) -> int:
    """A 64-bit list number; its last bit says that distances are from the end."""
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63) & ~1 | from_end


def lists(words: DataFrame, grams) -> DataFrame:
    """``LISTED`` rows of every word; rows with ``used`` grams (and their list's key) are listed one level deeper."""
    deeper = "used" in words.columns

    def run(batches):
        dictionary = grams.value
        for batch in batches:
            columns = [T.column(batch, c).to_pylist() for c in (("word", "n", "key", "used") if deeper else ("word", "n"))]
            key, word, n, used, final = [], [], [], [], []
            for own, count, *old in zip(*columns):
                prefix, taken = (f"{old[0]}|", old[1]) if deeper else ("", [])
                found, kept = dictionary.listed(own, taken)
                keys = [(list_key(prefix + text, ">" in text), place) for place, text in found]
                if deeper and kept <= len(taken):  # two such words may have no other gram in common
                    keys.append((list_key(prefix, False), None))
                for k, place in keys:
                    key.append(k)
                    used.append([*taken, place] if place is not None else taken)
                    final.append(place is None)
                word += [own] * len(keys)
                n += [count] * len(keys)
            for at in range(0, len(key), 20_000):
                to = at + 20_000
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[at:to], pa.int64()), pa.array(word[at:to], pa.string()), pa.array(n[at:to], pa.int64()),
                    pa.array(used[at:to], pa.list_(pa.int32())), pa.array(final[at:to], pa.bool_())],
                    ["key", "word", "n", "used", "final"])

    return words.mapInArrow(run, LISTED)


def latin(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte for each code point (up to U+00FF) and word offsets; eight zero bytes at the end."""
    data, at = T.utf8(words)
    body = data[:at[-1]]
    head = (body & 0xC0) != 0x80
    wide = body >= 0xC0
    letters = np.where(wide, (body & 3) << 6 | data[1:at[-1] + 1] & 0x3F, body)[head]
    before = np.concatenate([[0], np.cumsum(head)])
    return np.concatenate([letters, np.zeros(8, np.uint8)]), before[at]


def common(data: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes from ``x`` and ``y`` on agree, up to ``most``."""
    out = most.copy()
    window = np.ndarray((len(data) - 7,), np.uint64, data, 0, (1,))
    left = np.flatnonzero(most > 0)
    done = 0
    while len(left):
        differ = window[x[left] + done] ^ window[y[left] + done]
        same = np.where(differ == 0, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) // 8).astype(np.int64)
        ended = same < 8
        out[left[ended]] = np.minimum(out[left[ended]], done + same[ended])
        done += 8
        left = left[~ended]
        left = left[most[left] > done]
    return out


def one_edit(data: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which word pairs (the right one as long or one letter longer) differ by exactly one edit."""
    size = np.diff(at)
    x, y, short = at[left], at[right], size[left]
    longer = size[right] - short
    head = common(data, x, y, short)
    differ = (head < short) | (longer == 1)
    skip = 1 - longer  # a replaced letter is skipped on both sides, an inserted one on the right
    rest = np.maximum(short - head - skip, 0)
    end = len(data) - 8
    tail = common(data, np.minimum(x + head + skip, end), np.minimum(y + head + 1, end), rest)
    return differ & (tail == rest)


def merged(keys: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs within the lists; rows are sorted by list and length of the word."""
    data, at = latin(words)
    size = np.diff(at)
    run = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
    place = run * (int(size.max(initial=0)) + 3) + size
    partners = np.searchsorted(place, place + 1, "right") - np.arange(len(keys)) - 1
    # Words of equal length agree from the start on, so lists by distance from the end leave them out.
    skip = np.where(keys & 1, np.searchsorted(place, place, "right") - np.arange(len(keys)) - 1, 0)
    partners -= skip
    ends = np.cumsum(partners)
    lefts, rights, row = [], [], 0
    while row < len(keys):
        to = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + PAIRS, "right")))
        rows = np.arange(row, to)
        left = np.repeat(rows, partners[row:to])
        right = T.ranges(rows + 1 + skip[row:to], partners[row:to])
        near = one_edit(data, at, left, right)
        lefts.append(left[near])
        rights.append(right[near])
        row = to
    return np.concatenate([np.zeros(0, np.int64), *lefts]), np.concatenate([np.zeros(0, np.int64), *rights])


def near_pairs(listed: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: the verified pairs of all lists (a pair may come from several)."""
    def pairs(rows: pa.Table) -> pa.RecordBatch:
        words = rows.column("word").combine_chunks()
        left, right = merged(rows.column("key").to_numpy(), words)
        n = rows.column("n").to_numpy()
        found = pa.table({"a": words.take(pa.array(left)), "n_a": n[left], "b": words.take(pa.array(right)), "n_b": n[right]})
        # A pair that several lists of this task have leaves it once.
        return found.group_by(["a", "n_a", "b", "n_b"]).aggregate([]).combine_chunks()

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 200_000:
                whole = pa.Table.from_batches(held)
                keys = whole.column("key").to_numpy()
                last = int(np.searchsorted(keys, keys[-1], "left"))  # the run that may go on
                if last:
                    yield from pairs(whole.slice(0, last)).to_batches()
                    held = whole.slice(last).combine_chunks().to_batches()
                    rows = whole.num_rows - last
        if rows:
            yield from pairs(pa.Table.from_batches(held)).to_batches()

    sorted_ = listed.select("key", "word", "n").repartition("key").sortWithinPartitions("key", F.length("word"))
    return sorted_.mapInArrow(run, "a string, n_a bigint, b string, n_b bigint")


def links(words: DataFrame, frequent: int = FREQUENT, longest: int = LONGEST, list_limit: int = LIST_LIMIT) -> DataFrame:
    """a, n_a, b, n_b: every pair of words one edit apart, once."""
    spark = words.sparkSession
    grams = spark.sparkContext.broadcast(gram_dictionary(words, frequent, longest))
    rows = stored(lists(words.select("word", "n"), grams))
    found = None
    while True:
        sizes = rows.where("not final").groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        hot, seen = stored_with(sizes.where(F.col("size") > list_limit).select("key"), n=F.count(F.lit(1)))
        small = rows.join(hot, "key", "left_anti") if seen["n"] else rows
        pairs = near_pairs(small)
        found = pairs if found is None else found.unionByName(pairs)
        if not seen["n"]:
            ordered = F.col("a") < F.col("b")  # lists have the shorter word first, equal lengths any
            both = [F.when(ordered, x).otherwise(y).alias(name) for x, y, name in (
                (F.col("a"), F.col("b"), "a"), (F.col("n_a"), F.col("n_b"), "n_a"),
                (F.col("b"), F.col("a"), "b"), (F.col("n_b"), F.col("n_a"), "n_b"))]
            return found.select(*both).distinct()
        rows = stored(lists(rows.join(hot, "key", "left_semi").select("word", "n", "key", "used"), grams))


def group_variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST_WORD,
                   least: int = LEAST_COUNT, frequent: int = FREQUENT, longest: int = LONGEST,
                   list_limit: int = LIST_LIMIT) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the documents."""
    if longest > shortest:
        raise ValueError("grams longer than the shortest word leave no gram that an edit spares")
    words = stored(count_words(documents, id_col, text_col, shortest, least))
    pairs = stored(links(words, frequent, longest, list_limit))
    both = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("n_near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("n_near")))
    best = F.min(F.struct((-F.col("n_near")).alias("m"), F.col("near")))
    near = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    common_form = -F.col("best.m") >= 2 * F.col("n")
    near = stored(near.select("word", "n_near", F.when(common_form, F.col("best.near")).alias("form"),
                              F.when(common_form, -F.col("best.m")).alias("form_n")))
    roots = follow(near.where("form is not null").select("word", F.col("form").alias("root")))
    return (words.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", "form_n",
                    F.coalesce("root", "word").alias("root")))


def follow(forms: DataFrame) -> DataFrame:
    """word, root: the last form of each chain, by pointer doubling."""
    now = stored(forms)
    while True:
        above = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(above, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        after, seen = stored_with(joined, moved=F.count("next"))
        if not seen["moved"]:
            return now
        now = after.select("word", "root")
