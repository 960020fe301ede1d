"""Substring dedup: repeated windows of words found by FM-indexes over wavelet trees.

Every window of ``window`` words has a minimizer (the least hash among its word
4-grams).  Neighbouring windows with the same minimizer form a segment, and equal
windows always have equal minimizers, so a segment has to be compared only with
the segments of its own minimizer: that is how text is dealt into shards.

1. Blocks of documents (bounded, written once) ask two sorted key ranges, after
   collapsing what repeats inside the block: how many different segments share a
   minimizer, and how often is a segment's very text found, here first or not?
   Answers carry numbers only.
2. Each different segment with a shared minimizer, with room for an inner repeat
   or found several times is indexed once: one compressed FM-index per shard,
   beside it the list of the segment's other occurrences.  The shard's segments
   are streamed backward through it, keeping matching statistics; where they
   reach the window length and the interval stands for more than one occurrence,
   its rows are located by the sampled places, and the window is reported for
   every occurrence of its segment but the earliest of all.
   Hot text fills no shard: the later ones of more than ``hot_segments``
   occurrences are copies by step 1 alone, and segments of a minimizer with more
   than ``hot_segments`` segments are cut into single windows, which blocks
   collapse and key ranges resolve as in step 1.
3. Copies cover words; what is left of each document is hashed.

Key ranges take at most ``fan_in`` blocks in one call: with more blocks, what
they ask is merged in groups first, and the answers go down the same way, so that
a passage of every block puts no row of every block into one task.

Windows are judged on the input.  Order is doc_id, then place; rows with equal
ids follow the order in which they are stored; null ids come last.  Null texts
have no words; texts below the window lose nothing; an empty table gives an
empty result; other columns are ignored.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretable.llm import blocks as B
from wiretable.llm import tokens as T
from wiretable.llm.fm_index import FMIndex
from wiretable.llm.frames import keyed, stored

WINDOW = 20
GRAM = 4
HOT_SEGMENTS = 1000
BLOCK_BYTES = 3 << 20
#: Blocks are written once and shuffled twice.
BLOCK_LEVEL = 6
SLICE = 1 << 14
RANGE_BYTES = 24 << 20
#: Blocks that ask one range in one call: some MB of headers, 48 GB of text before groups are merged.
FAN_IN = 1 << 14
#: Text of the corpus per shard; segments overlap about threefold, most are not shared.
SHARD_BYTES = 4 << 20
LAST = np.iinfo(np.int64).max
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Segments:
    """Segments of a block: document, first word (in the block), words, minimizer and content hash."""

    def __init__(self, words: T.Words, window: int):
        hashes = words.hashes()
        gram = T.grams(hashes, GRAM, 11)
        least, reach, width = gram, 1, window - GRAM + 1
        while reach * 2 <= width:
            least = np.minimum(least[:len(least) - reach], least[reach:])
            reach *= 2
        n = len(gram) - width + 1
        least = np.minimum(least[:n], least[width - reach:][:n]) if n > 0 else np.zeros(0, np.uint64)
        doc = words.doc_of()[:len(least)]
        at = np.arange(len(least))
        valid = at + window <= words.first[1:][doc]
        head = valid.copy()
        head[1:] &= ~(valid[:-1] & (least[1:] == least[:-1]) & (doc[1:] == doc[:-1]))
        self.at = np.flatnonzero(head)
        stop = valid.copy()
        stop[:-1] &= ~(valid[1:] & ~head[1:])
        self.windows = np.flatnonzero(stop) - self.at + 1
        self.size = self.windows + window - 1
        self.doc = doc[self.at]
        self.start = self.at - words.first[self.doc]
        self.minimizer = least[self.at]
        power = np.cumprod(np.full(len(hashes), _BASE, np.uint64)) if len(hashes) else hashes
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power)])
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        back = np.cumprod(np.full(len(hashes), inverse, np.uint64)) if len(hashes) else hashes
        span = (sums[self.at + self.size] - sums[self.at]) * back[self.at]
        self.content = T.mix(span ^ T.mix(self.size.astype(np.uint64)))
        # Two equal windows of one segment hold its minimizer at two places.
        held = self.size - GRAM + 1
        self.looped = np.zeros(len(held), bool)
        for a in range(0, len(held), SLICE):  # in slices, as segments overlap many times
            own, n = slice(a, a + SLICE), held[a:a + SLICE]
            places = np.repeat(self.minimizer[own], n) == gram[T.ranges(self.at[own], n)]
            self.looped[own] = np.add.reduceat(places.astype(np.int64), np.cumsum(n) - n) > 1


def _read(payload: bytes, window: int) -> tuple[pa.Table, np.ndarray, T.Words, Segments]:
    table = B.rows_of(payload)
    ids = table.column("doc_id").fill_null(int(LAST)).to_numpy()
    words = T.find_words(table.column("text").combine_chunks().fill_null(""))
    return table, ids, words, Segments(words, window)


def _firsts(keys: tuple[np.ndarray, ...], order: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """For groups of equal keys: places sorted by key then order, and where each group begins."""
    place = np.lexsort((*reversed(order), *reversed(keys)))
    fresh = np.zeros(len(place), bool)
    if len(place):
        fresh[0] = True
        for k in keys:
            s = k[place]
            fresh[1:] |= s[1:] != s[:-1]
    return place, np.flatnonzero(fresh)


def _check(minimizer: np.ndarray) -> np.ndarray:
    return (minimizer & np.uint64(0xFFFFFFFF)).astype(np.int64)


#: What blocks send: minimizers, texts and single windows to key ranges; segments to shards; known copies to themselves.
MINIMIZER, TEXT, WINDOWS, SEGMENTS, KNOWN = range(5)
REQUEST = "kind int, part bigint, block bigint, a binary, b binary, c binary, d binary, e binary, f binary, g binary"
_REQUEST = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("block", pa.int64()), *[(k, pa.binary()) for k in "abcdefg"]])
ANSWER = "kind int, part bigint, block bigint, flags binary"
LATE = "block bigint, docs binary, starts binary, stops binary"


def _row(kind: int, part: int, block: int, *values: bytes) -> dict:
    return {"kind": kind, "part": part, "block": block, **dict(zip("abcdefg", values))}


def _found(kind: int, part: int, block: int, keys, check, order, count) -> dict:
    """A row of sorted keys, each with the order (id, block, document, place) of its first occurrence and their number."""
    return _row(kind, part, block, B.pack(B.gaps(keys)), B.pack(check), *(B.pack(o) for o in order), B.pack(count))


def _asked(segments: Segments, ids: np.ndarray):
    """What a block asks, in key order: its distinct minimizers, and its distinct segment texts."""
    place, heads = _firsts((segments.minimizer,), (segments.content,))
    own, share = segments.minimizer[place[heads]], segments.content[place]
    fresh = np.concatenate([[True], share[1:] != share[:-1]]) if len(share) else np.zeros(0, bool)
    fresh[heads] = True
    stops = np.append(heads[1:], len(place)) - 1
    distinct = np.add.reduceat(fresh.astype(np.int64), heads) if len(heads) else heads
    minimizers = (own, share[heads] if len(heads) else share, share[stops] if len(heads) else share, distinct)
    texts, first = _firsts((segments.content, _check(segments.minimizer)),
                           (ids[segments.doc], segments.doc, segments.start))
    return minimizers, texts, first


def _requests(window: int, width: int):
    def run(batches):
        for batch in batches:
            for block, payload in zip(T.column(batch, "block").to_pylist(), T.column(batch, "payload").to_pylist()):
                _, ids, _, segments = _read(payload, window)
                (own, low, high, distinct), texts, first = _asked(segments, ids)
                rows = []
                for part, a, b in zip(*B.by_range(own, width)):
                    rows.append(_row(MINIMIZER, part, block, B.pack(B.gaps(own[a:b])), B.pack(low[a:b].view(np.int64)),
                                     B.pack((low[a:b] ^ high[a:b]).view(np.int64)), B.pack(distinct[a:b])))
                lead, held = texts[first], np.diff(np.append(first, len(texts)))
                content = segments.content[lead]
                for part, a, b in zip(*B.by_range(content, width)):
                    s = lead[a:b]
                    order = ids[segments.doc[s]], np.full(b - a, block), segments.doc[s], segments.start[s]
                    rows.append(_found(TEXT, part, block, content[a:b], _check(segments.minimizer[s]), order, held[a:b]))
                pa.default_memory_pool().release_unused()
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _REQUEST)
    return run


class Asked:
    """What some blocks (or groups of them) ask one key range: groups of equal keys, in the order of their occurrences."""

    def __init__(self, table: pa.Table):
        self.table, self.kind = table, table.column("kind")[0].as_py()
        keys = [np.cumsum(k) for k in self.read("a", np.uint64)]
        self.cuts = np.cumsum([len(k) for k in keys])[:-1]
        self.key = np.concatenate(keys)
        if self.kind == MINIMIZER:
            self.low = np.concatenate(self.read("b", np.uint64))
            self.high = self.low ^ np.concatenate(self.read("c", np.uint64))
            self.count = np.concatenate(self.read("d"))
            self.place, self.heads = _firsts((self.key,), ())
        else:
            self.check, *self.order, self.count = (np.concatenate(self.read(k)) for k in "bcdefg")
            self.place, self.heads = _firsts((self.key, self.check), tuple(self.order))
        self.total = np.add.reduceat(self.count[self.place], self.heads)

    def read(self, name: str, kind: type = np.int64) -> list[np.ndarray]:
        return [B.unpack(x.as_py(), kind) for x in self.table.column(name)]

    def merged(self) -> dict:
        """The group asks as one."""
        part, node = self.table.column("part")[0].as_py(), self.table.column("node")[0].as_py()
        lead = self.place[self.heads]
        if self.kind == MINIMIZER:
            low, high = (f.reduceat(x[self.place], self.heads) for f, x in ((np.minimum, self.low), (np.maximum, self.high)))
            return _row(self.kind, part, node, B.pack(B.gaps(self.key[lead])), B.pack(low.view(np.int64)),
                        B.pack((low ^ high).view(np.int64)), B.pack(self.total))
        return _found(self.kind, part, node, self.key[lead], self.check[lead], [o[lead] for o in self.order], self.total)

    def flags(self, above: np.ndarray | None = None) -> np.ndarray:
        """Minimizers: 0 one segment has it, else how many.  Others: how often found, negative where found earlier.

        ``above``: the answers to the merged keys, where others ask as well.
        """
        if above is not None and len(above) != len(self.heads):
            raise ValueError("the answers do not fit the merged keys")
        out = np.empty(len(self.place), np.int64)
        each = np.diff(np.append(self.heads, len(self.place)))
        if self.kind == MINIMIZER:
            if above is None:
                few = np.minimum.reduceat(self.low[self.place], self.heads) == np.maximum.reduceat(self.high[self.place], self.heads)
                above = np.where(few, 0, self.total)
            out[self.place] = np.repeat(above, each)
        else:
            above = self.total if above is None else above
            out[self.place] = -np.repeat(np.abs(above), each)
            out[self.place[self.heads]] = above
        return out

    def answers(self, flags: np.ndarray) -> pa.Table:
        return self.table.select(["kind", "part", "block"]).append_column(
            "flags", pa.array([B.pack(x) for x in np.split(flags, self.cuts)], pa.binary()))

    def late(self, flags: np.ndarray) -> pa.Table:
        """Windows that are found earlier, packed by block."""
        _, block, doc, start = (o[flags < 0] for o in self.order)
        return _by_block(block, doc, start, None)


def _judged(asked: DataFrame, blocks: int, emit: Callable, schema: str, fan_in: int) -> DataFrame:
    """``emit(asked, flags)`` of every key range."""
    def top(table: pa.Table) -> pa.Table:
        own = Asked(table)
        return emit(own, own.flags())

    if blocks <= fan_in:
        return asked.groupBy("kind", "part").applyInArrow(top, schema)

    def merge(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([Asked(table).merged()], _REQUEST)

    def descend(table: pa.Table, above: pa.Table) -> pa.Table:
        own = Asked(table)
        return emit(own, own.flags(B.unpack(above.column("flags")[0].as_py())))

    nodes = 1 << (-(-blocks // fan_in) - 1).bit_length()
    asked = stored(asked).withColumn("node", F.pmod(F.xxhash64("block"), F.lit(nodes)).cast("bigint"))
    group = ["kind", "part", "node"]
    above = _judged(asked.groupBy(*group).applyInArrow(merge, REQUEST), nodes, Asked.answers, ANSWER, fan_in)
    return asked.groupBy(*group).cogroup(above.withColumnRenamed("block", "node").groupBy(*group)).applyInArrow(descend, schema)


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _kept(words: T.Words, hit: np.ndarray) -> tuple[list[int], list[str]]:
    """Removed words and the hash of what is left, for each document."""
    lens = words.ends - words.starts
    removed, prints = [], []
    for a, b in zip(words.first[:-1], words.first[1:]):
        keep = np.flatnonzero(~hit[a:b]) + a
        removed.append(int(b - a - len(keep)))
        body = words.data[T.ranges(words.starts[keep], lens[keep] + 1)]
        body[np.cumsum(lens[keep] + 1) - 1] = 0x20
        prints.append(hashlib.sha256(body[:-1].tobytes() if len(keep) else b"").hexdigest())
    return removed, prints


def _dealt(block: int, part: np.ndarray, rows: pa.Table) -> list[dict]:
    """One packed row per shard of segments in any order."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    stops = np.append(heads[1:], len(part))
    rows = rows.take(pa.array(order))
    return [_row(SEGMENTS, part[x], block, _stream(rows.slice(x, y - x))) for x, y in zip(heads.tolist(), stops.tolist())]


def _resolve(window: int, hot_segments: int, width: int, shard_bits: int):
    """A block with its answers: the copies known by them, and what is left to ask."""

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for block, payload in zip(rows.column("block").to_pylist(), rows.column("payload").to_pylist()):
            table, ids, words, segments = _read(payload, window)
            (own, _, _, _), texts, first = _asked(segments, ids)
            flags = []
            for kind, size in ((MINIMIZER, len(own)), (TEXT, len(first))):
                some = answers.filter(pc.equal(answers.column("kind"), kind)).sort_by("part")
                got = [B.unpack(x.as_py()) for x in some.column("flags")]
                flags.append(np.concatenate(got) if got else np.zeros(0, np.int64))
                if len(flags[-1]) != size:
                    raise ValueError("the answers do not fit the block's segments")
            shared = flags[0][np.searchsorted(own, segments.minimizer)] if len(own) else np.zeros(0, np.int64)
            copy = np.ones(len(texts), bool)
            copy[texts[first]] = flags[1] < 0
            total = np.zeros(len(texts), np.int64)
            total[texts] = np.repeat(np.abs(flags[1]), np.diff(np.append(first, len(texts))))
            listed = copy & (total <= hot_segments) & (shared <= hot_segments)
            known = copy & ~listed
            ask = ~copy & ((shared > 0) | segments.looped | ((total > 1) & (total <= hot_segments)))
            hot = ask & (shared > hot_segments)
            ask &= ~hot
            docs, starts, stops = ([x[known]] for x in (segments.doc, segments.start, segments.start + segments.size))

            which = np.flatnonzero(ask | listed)
            if len(which):
                doc = segments.doc[which]
                a, b = words.starts[segments.at[which]], words.ends[segments.at[which] + segments.size[which] - 1]
                body = [words.data[x:y].tobytes().decode() if own else None
                        for x, y, own in zip(a.tolist(), b.tolist(), ask[which].tolist())]
                shard = (T.mix(segments.minimizer[which]) >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else 0 * which
                out.extend(_dealt(block, shard, pa.table({
                    "doc": doc, "doc_id": ids[doc], "start": segments.start[which], "content": segments.content[which],
                    "check": _check(segments.minimizer[which]), "text": pa.array(body, pa.string())})))
            which = np.flatnonzero(hot)
            if len(which):
                at = T.ranges(segments.at[which], segments.windows[which])
                doc = np.repeat(segments.doc[which], segments.windows[which])
                start = at - words.first[doc]
                hashes = words.hashes()
                key, guard = T.grams(hashes, window, 21)[at], T.grams(hashes, window, 22)[at].view(np.int64)
                place, heads = _firsts((key, guard), (ids[doc], doc, start))
                late = np.ones(len(place), bool)
                late[heads] = False
                again = place[late]
                docs.append(doc[again])
                starts.append(start[again])
                stops.append(start[again] + window)
                lead, held = place[heads], np.diff(np.append(heads, len(place)))
                key = key[lead]
                for part, a, b in zip(*B.by_range(key, width)):
                    s = lead[a:b]
                    order = ids[doc[s]], np.full(b - a, block), doc[s], start[s]
                    out.append(_found(WINDOWS, part, block, key[a:b], guard[s], order, held[a:b]))
            docs, starts, stops = (np.concatenate(x) for x in (docs, starts, stops))
            if len(docs):
                out.append(_row(KNOWN, 0, block, B.pack(docs), B.pack(starts), B.pack(stops)))
        return pa.Table.from_pylist(out, _REQUEST)
    return run


def _by_block(block: np.ndarray, doc: np.ndarray, start: np.ndarray, stop: np.ndarray | None) -> pa.Table:
    order = np.argsort(block, kind="stable")
    block, doc, start = block[order], doc[order], start[order]
    heads = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else block
    stops = np.append(heads[1:], len(block))[:len(heads)]
    cut = lambda x: pa.array([B.pack(x[a:b]) for a, b in zip(heads, stops)], pa.binary())
    return pa.table({"block": pa.array(block[heads], pa.int64()), "docs": cut(doc), "starts": cut(start),
                     "stops": cut(stop[order]) if stop is not None else pa.nulls(len(heads), pa.binary())})


def repeated_windows(texts: pa.Array, order: tuple[np.ndarray, ...], start: np.ndarray, many: np.ndarray,
                     window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One shard: which windows of its segments occur more than once, and which of these are the earliest.

    ``order`` ranks the segments' documents, ``start`` is the first word of each
    segment in its document, ``many`` says that the segment has further
    occurrences.  Returns segment, place (in the segment) and earliest.
    """
    words = T.find_words(texts)
    _, ids = np.unique(words.hashes(), return_inverse=True)
    counts = words.counts
    begin = words.first[:-1] + np.arange(len(counts))  # one separator behind each segment
    text = np.zeros(len(ids) + len(counts), np.int64)
    text[np.arange(len(ids)) + words.doc_of()] = ids + 1
    index = FMIndex(text, int(text.max(initial=0)) + 1)
    # Rows with the same first ``window`` words: an interval is widened to them when its match grows longer.
    sep = np.cumsum(text == 0)
    gram = T.grams(T.mix(text.astype(np.uint64)), window, 31)
    whole = np.zeros(len(text), bool)
    whole[:len(gram)] = sep[window - 1:] == (sep - (text == 0))[:len(gram)]
    kind = np.where(whole, np.append(gram, np.zeros(len(text) - len(gram), np.uint64)), np.uint64(0))[index.order]
    inner = whole[index.order]
    fresh = np.concatenate([[True], (kind[1:] != kind[:-1]) | ~inner[1:] | ~inner[:-1]])
    row = np.arange(len(text))
    lower = np.maximum.accumulate(np.where(fresh, row, 0))
    heads = np.flatnonzero(fresh)
    upper = np.append(heads[1:], len(text))[np.cumsum(fresh) - 1]
    index.compress()

    # Stream all segments backward, longest first, one word a step.
    by_size = np.argsort(-counts, kind="stable")
    last = (begin + counts - 1)[by_size]
    sizes, many = counts[by_size], many[by_size]
    low, high = index.everything(len(sizes))
    matched = np.zeros(len(sizes), np.int64)
    at_, low_, high_ = [], [], []
    for k in range(int(sizes.max(initial=0))):
        live = int(np.searchsorted(-sizes, -k, "left"))
        place = last[:live] - k
        low[:live], high[:live] = index.extend(text[place], low[:live], high[:live])
        matched[:live] += 1
        long = np.flatnonzero(matched[:live] >= window)
        low[long], high[long], matched[long] = lower[low[long]], upper[low[long]], window
        more = long[(high[long] - low[long] > 1) | many[long]]  # an interval above the threshold
        at_.append(place[more])
        low_.append(low[more])
        high_.append(high[more])
    none = [np.zeros(0, np.int64)]
    at, lows, highs = (np.concatenate(x or none) for x in (at_, low_, high_))
    earliest = np.ones(len(at), bool)  # an interval of one row is the window itself
    wide = np.flatnonzero(highs - lows > 1)
    intervals, which = np.unique(lows[wide], return_inverse=True)
    ends = np.zeros(len(intervals), np.int64)
    ends[which] = highs[wide]
    size = ends - intervals
    places = index.locate(T.ranges(intervals, size))
    segment = np.searchsorted(begin, places, "right") - 1
    keys = tuple(o[segment] for o in order) + (start[segment] + places - begin[segment],)
    ranked = np.lexsort((*reversed(keys), np.repeat(np.arange(len(intervals)), size)))
    earliest[wide] = at[wide] == places[ranked[np.cumsum(size) - size]][which]
    segment = np.searchsorted(begin, at, "right") - 1
    return segment, at - begin[segment], earliest


def _spans(segment: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows: segment, first and last window."""
    order = np.lexsort((at, segment))
    segment, at = segment[order], at[order]
    heads = np.flatnonzero(np.concatenate([[True], (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1)])[:len(at)])
    last = np.append(heads[1:], len(at))[:len(heads)] - 1
    return segment[heads], at[heads], at[last]


def _shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        parts = [B.rows_of(x.as_py()) for x in table.column("a")]
        block = np.repeat(table.column("block").to_numpy(), [p.num_rows for p in parts])
        rows = pa.concat_tables(parts).combine_chunks()
        doc, doc_id, start, content, check = (rows.column(c).to_numpy() for c in ("doc", "doc_id", "start", "content", "check"))
        listed = rows.column("text").is_null().to_numpy(zero_copy_only=False)
        own = np.flatnonzero(~listed)
        # Each listed occurrence follows the segment that has its text.
        place, heads = _firsts((content, check), (listed,))
        held = np.diff(np.append(heads, len(place)))
        at_own = np.full(len(rows), -1, np.int64)
        at_own[own] = np.arange(len(own))
        segment_of = np.empty(len(rows), np.int64)
        segment_of[place] = np.repeat(at_own[place[heads]], held)
        if (segment_of < 0).any():
            raise ValueError("a listed occurrence without its segment's text")
        many = np.bincount(segment_of, minlength=len(own)) > 1
        segment, at, earliest = repeated_windows(rows.column("text").drop_null(), (doc_id[own], block[own], doc[own]),
                                                 start[own], many, window)
        lead, first, last = _spans(segment[~earliest], at[~earliest])
        lead = own[lead]
        # What is repeated in a segment is a copy in all its later occurrences.
        of, begin, stop = _spans(segment, at)
        bounds = np.searchsorted(of, np.arange(len(own) + 1))
        later = np.flatnonzero(listed)
        base, n = bounds[segment_of[later]], np.diff(bounds)[segment_of[later]]
        spans = T.ranges(base, n)
        row = np.concatenate([lead, np.repeat(later, n)])
        first, last = np.concatenate([first, begin[spans]]), np.concatenate([last, stop[spans]])
        return _by_block(block[row], doc[row], start[row] + first, start[row] + last + window)
    return run


def _finish(window: int):
    def run(rows: pa.Table, late: pa.Table) -> pa.Table:
        out = []
        docs, starts, stops = [], [], []
        for some in late.to_batches():
            for d, a, b in zip(*(T.column(some, k).to_pylist() for k in ("docs", "starts", "stops"))):
                docs.append(B.unpack(d))
                starts.append(B.unpack(a))
                stops.append(B.unpack(b) if b is not None else starts[-1] + window)
        for payload in rows.column("payload").to_pylist():
            table = B.rows_of(payload)
            words = T.find_words(table.column("text").combine_chunks().fill_null(""))
            begin = end = np.zeros(0, np.int64)
            if docs:
                at = words.first[np.concatenate(docs)]
                begin, end = np.concatenate(starts) + at, np.concatenate(stops) + at
            hit = T.covered(len(words.starts), begin, end)
            removed, prints = _kept(words, hit)
            out.append(pa.table({"doc_id": table.column("doc_id"), "n_words": pa.array(words.counts, pa.int64()),
                                 "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(prints, pa.string())}))
        return pa.concat_tables(out) if out else pa.table({
            "doc_id": pa.nulls(0, pa.int64()), "n_words": pa.nulls(0, pa.int64()), "n_removed": pa.nulls(0, pa.int64()),
            "kept_sha256": pa.nulls(0, pa.string())})
    return run


def drop_repeats(documents: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                 hot_segments: int = HOT_SEGMENTS, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES,
                 shard_bytes: int = SHARD_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by spaces) of every row."""
    packed = B.in_blocks(keyed(documents, id_col, text_col, False), limit=block_bytes, level=BLOCK_LEVEL)
    size, blocks = packed.agg(F.sum("n_bytes"), F.count(F.lit(1))).first()
    width = B.ranges_for(size or 0, range_bytes)
    shard_bits = B.ranges_for(size or 0, shard_bytes)
    rows = packed.select("block", "payload")
    answers = _judged(rows.mapInArrow(_requests(window, width), REQUEST), blocks, Asked.answers, ANSWER, fan_in)
    found = stored(rows.groupBy("block").cogroup(answers.groupBy("block"))
                   .applyInArrow(_resolve(window, hot_segments, width, shard_bits), REQUEST))
    known = found.where(F.col("kind") == KNOWN).select("block", F.col("a").alias("docs"), F.col("b").alias("starts"),
                                                       F.col("c").alias("stops"))
    copies = found.where(F.col("kind") == SEGMENTS).select("part", "block", "a").groupBy("part").applyInArrow(_shard(window), LATE)
    late = _judged(found.where(F.col("kind") == WINDOWS), blocks, Asked.late, LATE, fan_in)
    return rows.groupBy("block").cogroup(known.unionByName(copies).unionByName(late).groupBy("block")).applyInArrow(
        _finish(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
