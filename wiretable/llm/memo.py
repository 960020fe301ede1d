"""Token ids of words, remembered by a Python worker from chunk to chunk and task to task.

Both tokenizers cut a text into words that no token crosses, and words repeat:
a chunk's distinct words are looked up and only unknown ones are encoded.  Words
are known by 64-bit hashes.  The memory is bounded: it holds two generations of
at most ``WORDS_KEPT`` words each, and a full one replaces the older, so words in
use stay and forgetting changes no result.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np

from wiretable.llm import tokens as T

WORDS_KEPT = 200_000
#: Models a worker keeps at once.
MODELS_KEPT = 4


def per_worker(key: tuple, make: Callable):
    """The object that this Python worker made for ``key``, made once and kept for later tasks.

    Task code travels by value, so its own globals are new in every task; the
    objects hang on a module entry of the process instead.
    """
    name = "wiretable_worker_state"
    held = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("held", {})
    if key not in held:
        if len(held) >= MODELS_KEPT:
            held.pop(next(iter(held)))
        held[key] = make()
    return held[key]


class WordMemory:
    """Ids of the words seen so far (as packed 32-bit numbers) by word hash."""

    def __init__(self, limit: int = WORDS_KEPT):
        self.limit = limit
        self.young: dict[int, bytes] = {}
        self.old: dict[int, bytes] = {}

    def find(self, keys: list[int]) -> list[bytes | None]:
        """Packed ids by key, None for unknown words."""
        young, old = self.young, self.old
        found = [young.get(k) for k in keys]
        for i, x in enumerate(found):
            if x is None:
                x = old.get(keys[i])
                if x is not None:
                    young[keys[i]] = found[i] = x
        return found

    def add(self, key: int, ids: bytes) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = ids


def word_ids(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, memory: WordMemory,
             encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all word spans behind one another, and the number of ids of each word.

    ``encode`` gets the distinct unknown words as bytes and returns their ids
    behind one another and the number of ids of each.
    """
    keys, first, place = np.unique(T.hash_spans(data, starts, lens), return_index=True, return_inverse=True)
    keys = keys.tolist()
    found = memory.find(keys)
    new = [k for k, x in enumerate(found) if x is None]
    at = first[new]
    words = [data[a:a + n].tobytes() for a, n in zip(starts[at].tolist(), lens[at].tolist())]
    if words:
        ids, sizes = encode(words)
        body, ends = ids.astype(np.int32).tobytes(), 4 * np.cumsum(sizes)
        for k, a, b in zip(new, (ends - 4 * sizes).tolist(), ends.tolist()):
            found[k] = body[a:b]
            memory.add(keys[k], found[k])
    size = np.fromiter(map(len, found), np.int64, len(found)) // 4
    flat = np.frombuffer(b"".join(found), np.int32)
    begin = np.cumsum(size) - size
    return flat[T.ranges(begin[place], size[place])], size[place]
