"""SentencePiece encoding and decoding by a Viterbi pass shared over word prefixes.

Texts are marked as the model does (a blank in front, blanks as U+2581) and cut
into marked words, which no piece crosses.  The distinct words of a chunk are
sorted, so that walking the list is a depth-first walk of their trie: the forward
state of a common prefix is computed once and reused by all words below it.

The forward state of a prefix is the last piece of its best segmentation.  For a
merge (BPE) model the best segmentation is the one its merges make, not the one
with the largest sum of scores; it is found by the same left-to-right pass: the
last piece of a prefix is the one piece ending there that stays apart from the
last piece before it when the two are merged alone.  Unknown characters are
spelled in byte pieces.  The model's file is read by the driver and its path is
a parameter; nothing is trained.

Defined results: null and empty texts have no pieces and decode to an empty
text; a U+2581 in a text reads as a blank, as in the model; repeated rows are
encoded one by one; an empty table gives an empty result; other columns are
ignored, or returned inside ``row`` with ``carry``.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wiretable.llm import tokens as T
from wiretable.llm.frames import keyed
from wiretable.llm.memo import WordMemory, per_worker, word_ids

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Piece pairs that a worker remembers.
PAIRS_KEPT = 1_000_000
UNKNOWN = -1


class Pieces:
    """Pieces of a model and the forward pass over words."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
        is_byte = [sp.is_byte(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(self.text) if not special[i] and not is_byte[i]}
        self.score = [sp.get_score(i) for i in range(size)]
        self.bytes = {int(self.text[i][1:-1], 16): i for i in range(size) if is_byte[i]}
        self.backward: dict = {}  # trie of reversed pieces; a node holds its piece under ""
        for piece, i in self.ids.items():
            node = self.backward
            for char in reversed(piece):
                node = node.setdefault(char, {})
            node[""] = i
        if any(MARK in p.lstrip(MARK) for p in self.ids) or len(self.bytes) != 256:
            raise ValueError("the model has pieces that cross words, or no byte pieces")
        plain = [bytes([int(p[1:-1], 16)]) if b else b"" if s else p.replace(MARK, " ").encode()
                 for p, b, s in zip(self.text, is_byte, special)]
        self.plain = np.frombuffer(b"".join(plain) + bytes(8), np.uint8)
        self.plain_size = np.array([len(p) for p in plain], np.int64)
        self.plain_at = np.cumsum(self.plain_size) - self.plain_size
        self.apart: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces that the model's merges make of a text: best score first, leftmost first."""
        parts = list(text)
        ids, score = self.ids, self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or score[i] > best):
                    best, at = score[i], k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays_apart(self, before: int, piece: int) -> bool:
        """Whether the merges leave a piece (after ``before``, or alone) as it is."""
        key = before << 32 | piece
        known = self.apart.get(key)
        if known is None:
            own = self.text[piece]
            want = [own] if before == UNKNOWN else [self.text[before], own]
            known = self.merged("".join(want)) == want
            if len(self.apart) >= PAIRS_KEPT:
                self.apart.clear()
            self.apart[key] = known
        return known

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Piece ids of sorted words; prefixes shared with the word before are not computed again."""
        backward, apart = self.backward, self.apart
        out, before = [], ""
        last: list[int] = []  # last piece of each prefix
        begin: list[int] = []  # where that piece begins
        for word in words:
            n = len(word)
            same = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                same += 1
            del last[same:], begin[same:]
            for end in range(same + 1, n + 1):
                node = backward
                for at in range(end - 1, -1, -1):
                    node = node.get(word[at])
                    if node is None:
                        at, piece = end - 1, UNKNOWN
                        break
                    piece = node.get("")
                    if piece is None:
                        continue
                    prior = last[at - 1] if at else UNKNOWN
                    good = apart.get(prior << 32 | piece)
                    if good or good is None and self.stays_apart(prior, piece):
                        break
                else:
                    at, piece = end - 1, UNKNOWN
                last.append(piece)
                begin.append(at)
            pieces, end = [], n
            while end:
                piece = last[end - 1]
                if piece == UNKNOWN:
                    pieces += [self.bytes[b] for b in reversed(word[begin[end - 1]:end].encode())]
                else:
                    pieces.append(piece)
                end = begin[end - 1]
            pieces.reverse()
            out.append(pieces)
            before = word
        return out

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of words in any order behind one another (blanks stand for marks), and the number of each."""
        marked = [w.decode().replace(" ", MARK) for w in words]
        order = sorted(range(len(words)), key=marked.__getitem__)
        out: list = [None] * len(words)
        for k, ids in zip(order, self.encode_sorted([marked[k] for k in order])):
            out[k] = ids
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(itertools.chain.from_iterable(out), np.int32, int(sizes.sum())), sizes


def worker_state(proto: bytes) -> tuple[Pieces, WordMemory]:
    """The model's tables and the words known so far, kept by the Python worker."""
    return per_worker(("sentencepiece", hashlib.sha256(proto).hexdigest()), lambda: (Pieces(proto), WordMemory()))


def encode_texts(texts: pa.Array, pieces: Pieces, memory: WordMemory) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts behind one another, and the first id of each text (one more than texts)."""
    data, docs = T.utf8(pc.replace_substring(texts, MARK, " "))
    sizes = np.diff(docs)
    filled = sizes > 0
    data = np.insert(data, docs[:-1][filled], 0x20)  # the blank in front
    docs = np.concatenate([[0], np.cumsum(sizes + filled)])
    blank = data[:docs[-1]] == 0x20
    head = blank.copy()
    head[1:] &= ~blank[:-1]
    head[docs[:-1][filled]] = True
    starts = np.flatnonzero(head)
    lens = np.diff(np.append(starts, docs[-1]))
    ids, size = word_ids(data, starts, lens, memory, pieces.encode_words)
    before = np.concatenate([[0], np.cumsum(size)])
    return ids, before[np.searchsorted(starts, docs)]


def decode_ids(ids: np.ndarray, first: np.ndarray, pieces: Pieces) -> list[bytes]:
    """The bytes of each text, without the blank in front."""
    size = pieces.plain_size[ids]
    body = pieces.plain[T.ranges(pieces.plain_at[ids], size)]
    ends = np.concatenate([[0], np.cumsum(size)])[first]
    return [body[a + (body[a] == 0x20):b].tobytes() if b > a else b"" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(documents: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True, with_digests: bool = False, carry: bool = False) -> DataFrame:
    """doc_id and n_tokens of every row; the piece ids; digests of the ids and of their decoded text.

    ids_sha256 is over the ids as little-endian 32-bit numbers, decoded_sha256
    over the UTF-8 bytes that the ids decode to.
    """
    rows = keyed(documents, id_col, text_col, carry)
    kept = [n for n in rows.columns if n != "text"]
    schema = StructType([rows.schema[n] for n in kept] + [StructField("n_tokens", LongType())]
                        + [StructField("ids", ArrayType(IntegerType()))] * with_ids
                        + [StructField(n, StringType()) for n in ("ids_sha256", "decoded_sha256") if with_digests])
    proto = _model(model)

    def run(batches):
        pieces, memory = worker_state(proto)
        for batch in T.chunks(batches):
            ids, first = encode_texts(T.whole(batch), pieces, memory)
            out = [T.column(batch, n) for n in kept] + [pa.array(np.diff(first))]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32())))
            if with_digests:
                sha = hashlib.sha256
                out.append(pa.array([sha(ids[a:b].tobytes()).hexdigest() for a, b in zip(first[:-1], first[1:])], pa.string()))
                out.append(pa.array([sha(x).hexdigest() for x in decode_ids(ids, first, pieces)], pa.string()))
            yield pa.RecordBatch.from_arrays(out, schema.names)

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text that the ids stand for (null ids: an empty text)."""
    proto = _model(model)

    def run(batches):
        pieces, _ = worker_state(proto)
        for batch in batches:
            lists = T.column(batch, "ids")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = [x.decode(errors="replace") for x in decode_ids(ids, first, pieces)]
            yield pa.RecordBatch.from_arrays([T.column(batch, "doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"cast(`{ids_col}` as array<int>) ids").mapInArrow(
        run, "doc_id bigint, text string")
