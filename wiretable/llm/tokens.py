"""Arrow text columns as numpy token arrays.

All functions work on the UTF-8 bytes of a chunk of whole documents: words
are byte spans, hashed eight bytes at a time, so no Python object is made per
word.  A chunk is bounded by bytes (a single longer document is a chunk of its
own), which bounds a task's memory whatever the batch size is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 2 << 20

#: Byte tables: which bytes belong to a word.
NON_BLANK = np.ones(256, bool)
NON_BLANK[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, letters a-z and every byte beyond ASCII (texts are lower-cased first).
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

LONG_WORD = 256
_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M2
    x ^= x >> np.uint64(27)
    x *= _M3
    return x ^ (x >> np.uint64(31))


def whole(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column without nulls (null texts read as empty)."""
    texts = batch.column(batch.schema.get_field_index(column))
    return pc.fill_null(texts, "") if texts.null_count else texts


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive rows whose texts take about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Words of a chunk.  ``first[d]:first[d + 1]`` are the words of document ``d``."""

    data: np.ndarray  # bytes of all documents, eight zero bytes at the end
    docs: np.ndarray  # byte offsets of the documents, one more than there are
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.docs) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends - self.starts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (with eight zero bytes behind) and document offsets of a string array."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.dtype(np.int64 if wide else np.int32)
    buffers = texts.buffers()
    if not len(texts):
        return np.zeros(8, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = (np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
            if buffers[2] is not None else np.zeros(0, np.uint8))
    data = np.zeros(len(body) + 8, np.uint8)
    data[:len(body)] = body
    return data, offsets - offsets[0]


def find_words(texts: pa.Array, table: np.ndarray = NON_BLANK, lower: bool = False) -> Words:
    """Maximal runs of the bytes of ``table`` (after lower-casing A-Z) in each document.

    ``lower`` also keeps the lower-cased bytes.
    """
    data, docs = utf8(texts)
    if lower:
        data = LOWER[data]
    inside = table[data]
    inside[docs[-1]:] = False
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    heads = docs[:-1][docs[:-1] < docs[-1]]
    before[heads] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[heads[heads > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, docs, starts, ends, np.searchsorted(starts, docs))


def hash_spans(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes everywhere."""
    lens = lens.astype(np.int64)
    out = mix(lens.astype(np.uint64) * _M1)
    if not len(starts):
        return out
    window = np.ndarray((len(data) - 7,), np.uint64, data, 0, (1,))  # eight bytes at each place
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    rest = np.flatnonzero((lens > 0) & (lens <= LONG_WORD))
    at = 0
    while len(rest):
        left = np.minimum(lens[rest] - at, 8)
        part = window[starts[rest] + at] & (ones >> ((8 - left) * 8).astype(np.uint64))
        out[rest] = mix(out[rest] * _M1 ^ part)
        at += 8
        rest = rest[lens[rest] > at]
    for i in np.flatnonzero(lens > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:starts[i] + lens[i]].tobytes(), 7)
    return out


def grams(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``size`` words that begin at each place (fewer places than words)."""
    n = max(0, len(hashes) - size + 1)
    out = np.full(n, seed, np.uint64)
    for k in range(size):
        out = mix(out * _M1 + hashes[k:k + n])
    return out


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All integers of the ranges ``start .. start + size``, one range behind the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = sizes > 0
    starts, sizes = starts[keep].astype(np.int64), sizes[keep].astype(np.int64)
    step = np.ones(total, np.int64)
    step[0] = starts[0]
    heads = np.cumsum(sizes)[:-1]
    step[heads] = starts[1:] - (starts[:-1] + sizes[:-1] - 1)
    return np.cumsum(step)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the intervals."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def cut(words: Words, doc: int, begins: np.ndarray, stops: np.ndarray) -> str:
    """The document without the bytes of the word spans ``begins .. stops`` (places in the document)."""
    body = words.data[words.docs[doc]:words.docs[doc + 1]].tobytes()
    base, first = words.docs[doc], words.first[doc]
    parts, at = [], 0
    for x, y in zip((words.starts[first + begins] - base).tolist(), (words.ends[first + stops - 1] - base).tolist()):
        parts.append(body[at:x])
        at = y
    return b"".join([*parts, body[at:]]).decode()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
