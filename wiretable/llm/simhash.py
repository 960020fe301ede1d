"""SimHash near-duplicates: fingerprints linked by a binary trie self-join.

The 64-bit fingerprints are the leaves of a binary trie.  Pairs of trie nodes
are traversed together from a common node downward; each step adds the bits in
which the two paths differ, and a pair of nodes whose difference exceeds the
error budget is given up with everything below it.

For Spark the work is split by pigeonhole: fingerprints within ``distance`` bits
agree on at least one of ``distance + 1`` blocks, so each fingerprint is filed
once per block under the trie in which that block comes first, and the traversal
starts at the nodes of that block.  A node with more than ``node_limit`` leaves
is opened eight bits at a time into node pairs (by counted tables and joins)
until every pair is small; no node is ever gathered whole.

Equal fingerprints are one leaf (pre-aggregated).  A task does not emit the
pairs it finds but a spanning forest of them, so no link is lost and a group of
near copies gives no quadratic output; components are found distributed.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretable.llm import tokens as T
from wiretable.llm.components import connected_components
from wiretable.llm.frames import bounded, stored

SHINGLE = 3
DISTANCE = 3
SEED = 42
NODE_LIMIT = 4096
#: Leaves that one vectorised traversal takes at once.
LEAVES = 1 << 16


def shingle_hashes(words: T.Words, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, and the first shingle of each document (one more than documents)."""
    counts = words.counts
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    lens = words.ends - words.starts
    take = T.ranges(words.starts, lens + 1)
    body = words.data[take]  # words with one byte behind each
    stops = np.cumsum(lens + 1) - 1
    body[stops] = 0x20
    begin = stops - lens
    first = T.ranges(words.first[:-1], shingles)
    last = first + np.repeat(np.minimum(counts, size), shingles) - 1
    joined, digest = body.tobytes(), xxhash.xxh64_intdigest
    values = [digest(joined[a:b], seed) for a, b in zip(begin[first].tolist(), stops[last].tolist())]
    return np.array(values, np.uint64), np.concatenate([[0], np.cumsum(shingles)])


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document the bits that are set in over half of its hashes (0 without hashes)."""
    sizes = np.diff(first)
    piece = 1 << 15  # counts of a piece fit 16 bits, so one 64-bit sum counts four bits
    pieces = -(-sizes // piece)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    starts = first[:-1][owner] + (T.ranges(np.zeros(len(sizes), np.int64), pieces)) * piece
    counts = np.zeros((len(sizes), 64), np.int64)
    if len(starts):
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        for low in range(16):
            lanes = (hashes >> np.uint64(low)) & np.uint64(0x0001000100010001)
            sums = np.add.reduceat(lanes, starts)
            for lane in range(4):
                part = ((sums >> np.uint64(16 * lane)) & np.uint64(0xFFFF)).astype(np.int64)
                counts[owner[heads], 16 * lane + low] = np.add.reduceat(part, heads)
    bits = counts * 2 > sizes[:, None]
    return (bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64)


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id",
                 text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """doc_id and fp (the 64 bits as bigint) of every row; with ``row_col`` also that column as row_no."""
    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                            *([F.col(row_col).alias("row_no")] if row_col else []))
    kept = [n for n in rows.columns if n != "text"]

    def run(batches):
        for batch in T.chunks(batches):
            words = T.find_words(T.whole(batch), lower=True)
            fp = majority(*shingle_hashes(words, shingle, seed))
            yield pa.RecordBatch.from_arrays([T.column(batch, n) for n in kept] + [pa.array(fp.view(np.int64))], kept + ["fp"])

    return rows.mapInArrow(run, ", ".join(f"{n} bigint" for n in kept + ["fp"]))


def trie_links(leaves: np.ndarray, low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray,
               bits: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all leaves within ``budget`` bits, found by traversing pairs of nodes.

    A node is a range of the sorted ``leaves``; the given pairs of nodes agree
    above the lowest ``bits`` bits or are told apart by the traversal.  Links
    are pairs of leaves, or a star where two whole nodes are within the budget.
    """
    spent = np.zeros(len(low), np.int64)
    left, right = [], []
    for level in reversed(range(bits)):
        if not len(low):
            break
        same = low == other_low
        # Two leaves: their distance decides.
        single = (high - low == 1) & (other_high - other_low == 1)
        if single.any():
            a, b = low[single], other_low[single]
            near = (np.bitwise_count(leaves[a] ^ leaves[b]) <= budget) & (a != b)
            left.append(a[near])
            right.append(b[near])
        # Whatever the remaining bits are, the nodes are within the budget: link them whole.
        sure = ~single & (spent + level + 1 <= budget)
        for a, b, c, d in zip(low[sure], high[sure], other_low[sure], other_high[sure]):
            left += [np.arange(a, b), np.arange(c, d)]
            right += [np.full(b - a, c), np.full(d - c, a)]
        go = ~single & ~sure
        low, high, other_low, other_high, spent, same = (x[go] for x in (low, high, other_low, other_high, spent, same))
        if not len(low):
            break
        ones = np.concatenate([[0], np.cumsum((leaves >> np.uint64(level)) & np.uint64(1))]).astype(np.int64)
        mid = high - (ones[high] - ones[low])
        other_mid = other_high - (ones[other_high] - ones[other_low])
        cross = ~same
        parts = [(low, mid, other_low, other_mid, spent), (mid, high, other_mid, other_high, spent),
                 (low, mid, other_mid, other_high, spent + 1),
                 (mid[cross], high[cross], other_low[cross], other_mid[cross], spent[cross] + 1)]
        low, high, other_low, other_high, spent = (np.concatenate(x) for x in zip(*parts))
        keep = (low < high) & (other_low < other_high) & (spent <= budget)
        keep &= ~((low == other_low) & (high - low == 1))
        low, high, other_low, other_high, spent = (x[keep] for x in (low, high, other_low, other_high, spent))
    if len(low):  # no bits left: equal but for what was spent
        for a, b, c, d in zip(low, high, other_low, other_high):
            left += [np.arange(a, b), np.arange(c, d)]
            right += [np.full(b - a, c), np.full(d - c, a)]
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(left or empty), np.concatenate(right or empty)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least member of each of ``n`` places' component."""
    root = np.arange(n)
    while True:
        a, b = root[left], root[right]
        if (a == b).all():
            return root
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while ((jump := root[root]) != root).any():
            root = jump


def _tasks(batches, bits: int, budget: int):
    """Rows (task, side, leaf, fp), sorted by task and leaf: links found in each task."""
    rest: list[np.ndarray] = []

    def linked(rows: np.ndarray):
        task, side, leaf, fp = rows
        heads = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1]]))
        stops = np.append(heads[1:], len(task))
        two = np.add.reduceat(side, heads)  # members on the second side
        low, high = heads, np.where(two > 0, stops - two, stops)
        pair = (two > 0) & (high > low)
        other_low, other_high = np.where(pair, high, low), np.where(pair, stops, high)
        keep = (high > low) & (pair | (high - low > 1))
        left, right = trie_links(leaf.view(np.uint64), low[keep], high[keep], other_low[keep], other_high[keep], bits, budget)
        root = forest(len(task), left, right)
        own = np.flatnonzero(root != np.arange(len(task)))
        return pa.RecordBatch.from_arrays([pa.array(fp[own]), pa.array(fp[root[own]])], ["u", "v"])

    for batch in batches:
        rest.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]))
        rows = np.concatenate(rest, axis=1)
        whole = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0  # the last task may go on
        at = 0
        while at < whole:
            to = min(at + LEAVES, whole)
            if to < whole:
                edge = int(np.searchsorted(rows[0], rows[0][to], "left"))
                to = edge if edge > at else int(np.searchsorted(rows[0], rows[0][at], "right"))
            yield linked(rows[:, at:to])
            at = to
        rest = [rows[:, whole:]]
    if rest and rest[0].shape[1]:
        yield linked(rest[0])


def _tries(leaves: DataFrame, distance: int) -> DataFrame:
    """Each fingerprint once per block: trie number, and the bits rotated so that the block comes first."""
    blocks = distance + 1
    edges = [64 * k // blocks for k in range(blocks)]
    each = [F.struct(F.lit(k).alias("trie"),
                     (F.shiftleft("fp", e).bitwiseOR(F.shiftrightunsigned("fp", 64 - e)) if e else F.col("fp")).alias("leaf"))
            for k, e in enumerate(edges)]
    return leaves.select("fp", F.inline(F.array(*each)))


def links(leaves: DataFrame, distance: int = DISTANCE, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Edges u, v between fingerprints (column fp, distinct) that connect all within ``distance`` bits."""
    head = 64 // (distance + 1)  # every block has at least as many bits
    filed = _tries(leaves, distance)

    def node(depth: int):
        return F.shiftrightunsigned("leaf", 64 - depth) if depth < 64 else F.col("leaf")

    def counted(depth: int) -> DataFrame:
        return filed.groupBy("trie", node(depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))

    large = stored(counted(head).where(F.col("n") > node_limit))
    members = filed.withColumn("node", node(head))
    tasks = [members.join(large.select("trie", "node"), ["trie", "node"], "left_anti")
             .select(F.xxhash64("trie", "node").alias("task"), F.lit(0).cast("bigint").alias("side"), "leaf", "fp")]
    pairs = large.select("trie", F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).alias("spent"))
    depth = head
    while depth < 64 and pairs.head(1):
        step = min(8, 64 - depth)
        depth += step
        parent = F.shiftrightunsigned("node", step)
        child = counted(depth)
        left = child.select("trie", parent.alias("a"), F.col("node").alias("x"), F.col("n").alias("nx"))
        right = child.select("trie", parent.alias("b"), F.col("node").alias("y"), F.col("n").alias("ny"))
        spent = F.col("spent") + F.bit_count(F.col("x").bitwiseXOR(F.col("y")).bitwiseAND(F.lit((1 << step) - 1)))
        opened = stored(pairs.join(left, ["trie", "a"]).join(right, ["trie", "b"])
                        .where((spent <= distance) & ((F.col("a") != F.col("b")) | (F.col("x") <= F.col("y"))))
                        .select("trie", F.col("x").alias("a"), F.col("y").alias("b"), spent.cast("int").alias("spent"), "nx", "ny"))
        fits = (F.greatest("nx", "ny") <= node_limit) if depth < 64 else F.lit(True)
        ready = opened.where(fits).withColumn("task", F.xxhash64("trie", "a", "b", F.lit(depth)))
        own = filed.withColumn("node", node(depth))
        sides = [ready.select("trie", "task", F.col("a").alias("node"), F.lit(0).cast("bigint").alias("side")),
                 ready.where("a != b").select("trie", "task", F.col("b").alias("node"), F.lit(1).cast("bigint").alias("side"))]
        tasks += [own.join(s, ["trie", "node"]).select("task", "side", "leaf", "fp") for s in sides]
        pairs = opened.where(~fits).select("trie", "a", "b", "spent")
    rows = reduce(DataFrame.unionByName, tasks)
    # Sorted by unsigned leaf: the order of the trie's leaves.
    dealt = rows.repartition("task").sortWithinPartitions(
        "task", F.shiftrightunsigned("leaf", 1), F.col("leaf").bitwiseAND(F.lit(1)))
    return dealt.mapInArrow(lambda batches: _tasks(batches, 64, distance), "u bigint, v bigint")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED,
                    node_limit: int = NODE_LIMIT, id_col: str = "doc_id", text_col: str = "text",
                    row_col: str | None = None) -> DataFrame:
    """doc_id, fp, component_id (the least doc_id reachable) and root (a fingerprint that names the
    component) of every row; with ``row_col`` (a bigint column) also that column as row_no.

    Texts without words (null, empty, blanks) have fingerprint 0 and are linked
    like any other; rows with equal ids or texts each give a row; a null id is
    never a component id unless all ids of its component are null; an empty table
    gives an empty result; other columns are ignored.
    """
    prints = stored(fingerprints(documents, shingle, seed, id_col, text_col, row_col))
    leaves = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = stored(connected_components(links(leaves.select("fp"), distance, node_limit)))
    placed = leaves.join(roots, leaves.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    best = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(placed.join(best, "root").select("fp", "component_id", "root"), "fp").select(
        *[n for n in prints.columns if n != "fp"], "fp", "component_id", "root")


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """The input rows, one of each group of near duplicates: the least id, then the first stored.

    Null ids come last; repeated rows are one group; the columns are those of the input.
    """
    id_col = options.get("id_col", "doc_id")
    numbered = stored(documents.select(F.struct(*[documents[f"`{c}`"] for c in documents.columns]).alias("row"),
                                       F.monotonically_increasing_id().alias("row_no")))
    narrow = numbered.select(F.col("row")[id_col].alias("doc_id"), F.col("row")[options.get("text_col", "text")].alias("text"), "row_no")
    found = near_duplicates(narrow, **{**options, "id_col": "doc_id", "text_col": "text", "row_col": "row_no"})
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no")
    found = stored(found.select("root", "doc_id", "row_no"))
    first = found.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Rows of a large group stay where they are if the groups are few; so do the documents if few are dropped.
    kept = first.select("root", F.col("first.row_no").alias("kept"))
    dropped = bounded(found, kept, "root", "inner").where("row_no != kept").select("row_no")
    return bounded(numbered, dropped, "row_no", "left_anti").select("row.*")
