"""Ids of a byte-level BPE model of the ``tokenizers`` library, by distinct pieces of text.

The model first cuts a text by a pattern in which a single blank before a letter,
digit or sign always begins a new word.  A text is cut at such blanks (and only
where both neighbours are plainly no white space), and a piece is encoded once
per worker and remembered.  The ids are those of the whole text.
"""

from __future__ import annotations

import hashlib

import numpy as np

from wiretable.llm import tokens as T
from wiretable.llm.memo import WordMemory, per_worker, word_ids

ASCII_SIGN = np.zeros(256, bool)
ASCII_SIGN[0x21:0x7F] = True
#: Lead bytes of characters that are never white space, by the character's size.
LEADS = {2: (0xC3, 0xDF), 3: (0xE4, 0xEF), 4: (0xF0, 0xF4)}

#: Pieces are encoded together up to about this many bytes.
JOINED_BYTES = 1 << 14


def read_model(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def piece_starts(data: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Where the pieces of the documents begin (``docs``: byte offsets, eight zero bytes behind the last)."""
    n = int(docs[-1])
    body = data[:n + 1]
    lead = np.zeros(256, bool)
    before = ASCII_SIGN[body].copy()  # the character that ends here is no white space
    for size, (low, high) in LEADS.items():
        lead[low:high + 1] = True
        own = (body >= low) & (body <= high)
        before[size - 1:] |= own[:len(own) - size + 1]
    after = (ASCII_SIGN | lead)[body]
    cut = np.zeros(n, bool)
    cut[1:n] = (body[1:n] == 0x20) & before[:n - 1] & after[2:n + 1]
    heads = docs[:-1][np.diff(docs) > 0]
    cut[heads] = True
    return np.flatnonzero(cut)


class ByteTokens:
    """A model's encoder; ``plain``: special tokens' strings in a text are ordinary text."""

    def __init__(self, model: str, plain: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = plain

        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        #: Bytes of each id: an entry has one character for each byte, an added token its own text.
        self.n_bytes = np.array([len(added[i].content.encode()) if i in added else len(self.tokenizer.id_to_token(i) or "")
                                 for i in range(size)], np.int64)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces behind one another, and the number of ids of each.

        Pieces that can follow one another in a text are encoded as one text, as
        the library takes longer over many short ones; the bytes of the ids tell
        where a piece ends.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        joined = b"".join(words)
        data = np.frombuffer(joined + bytes(8), np.uint8)
        begins = ends - sizes
        free = np.zeros(len(joined) + 1, bool)
        free[piece_starts(data, np.array([0, len(joined)]))] = True
        apart = ~free[begins] | (begins // JOINED_BYTES != np.append(-1, begins[:-1] // JOINED_BYTES))
        cuts = begins[apart].tolist()
        texts = [joined[a:b].decode() for a, b in zip(cuts, [*cuts[1:], len(joined)])]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        at = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends, "left") + 1
        return ids, np.diff(at, prepend=0)


def worker_state(model: str, plain: bool) -> tuple[ByteTokens, WordMemory]:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    key = ("byte_bpe", hashlib.sha256(model.encode()).hexdigest(), plain)
    return per_worker(key, lambda: (ByteTokens(model, plain), WordMemory()))


def encode_bytes(data: np.ndarray, docs: np.ndarray, coder: ByteTokens, memory: WordMemory) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents behind one another, and the first id of each (one more than documents)."""
    if not docs[-1]:
        return np.zeros(0, np.int32), np.zeros(len(docs), np.int64)
    starts = piece_starts(data, docs)
    ids, size = word_ids(data, starts, np.diff(np.append(starts, docs[-1])), memory, coder.encode_words)
    before = np.concatenate([[0], np.cumsum(size)])
    return ids, before[np.searchsorted(starts, docs)]
