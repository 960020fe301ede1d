"""Alignment of two tokenizers' tokens by pointer jumping.

Both tokenizers cut the same bytes (a blank and the text), so tokens are byte
ranges, and tokens of the two sides are linked where their ranges overlap.  The
linked tokens fall into groups that end where a token of each side ends.

Every token points to its farthest-right overlapping token: a token of the first
side to the one of the second that holds its last byte, a token of the second side
to the one of the first unless both end there.  Following the pointers, each
round doubles the step (``pointer = pointer[pointer]``) for all tokens of a chunk
at once, until every pointer stays at its group's terminal token, which labels it.

Texts are read and encoded once.  What is written of a block of documents are its
distinct id pairs with their counts, and for each document its figures and how often
it links which of these pairs.  Blocks ask key ranges for the corpus-wide sums of
their pairs (``corpus_sums``) and weigh their documents' links with the answers.  A
key is the scrambled second id and the first id, so all pairs of a second id lie in
one range, which so knows their highest count; they are at most as many as the
first vocabulary has ids.

Defined results: texts that are null or empty, or whose tokens of either side do
not spell the blank and the text (a U+2581 reads as a blank), have no tokens, zeros
and empty groups; repeated rows are aligned and counted one by one; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretable.llm import blocks as B
from wiretable.llm import byte_tokens as BT
from wiretable.llm import tokens as T
from wiretable.llm.corpus_sums import ASKED, FAN_IN, corpus_values, requests
from wiretable.llm.frames import keyed, stored_with
from wiretable.llm.memo import WordMemory, per_worker, word_ids

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BLOCK_BYTES = 8 << 20
#: Keys of one range, over all blocks that ask.
RANGE_KEYS = 1 << 20
#: Bytes of text whose tokens are aligned at once (a longer document is a chunk of its own).
CHUNK_BYTES = 1 << 20
#: Odd, so that multiplying scrambles 32-bit ids without collisions.
SCRAMBLE = np.uint64(0x9E3779B1)
LOW = np.uint64(0xFFFFFFFF)


def byte_characters() -> dict[str, int]:
    """The printable character by which a byte-level vocabulary spells each byte, inverted.

    Visible Latin-1 characters stand for themselves, the other bytes, in order, for
    the characters from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class Spelling:
    """The bytes of every id, behind one another, and each id in decimal."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[T.ranges(self.at[ids], self.size[ids])]


class PieceTokens:
    """A SentencePiece model's encoder over marked words (a blank run and what follows)."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.blank = sp.piece_to_id(MARK)
        entries = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            empty = sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
            entries.append(bytes([int(piece[1:-1], 16)]) if sp.is_byte(i) else b"" if empty else piece.replace(MARK, " ").encode())
        self.spelling = Spelling(entries)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words; the model itself adds the first blank of each."""
        out = self.model.encode([w[1:].decode() for w in words], num_threads=1)
        out = [[self.blank] if w == b" " else ids for w, ids in zip(words, out)]
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter((i for ids in out for i in ids), np.int32, int(sizes.sum()))
        return flat, sizes


class Tokenizers:
    """Both encoders with their spellings and the words known so far; kept by the Python worker."""

    def __init__(self, byte_model: str, piece_model: bytes):
        self.first, self.first_memory = BT.ByteTokens(byte_model, True), WordMemory()
        self.second, self.second_memory = PieceTokens(piece_model), WordMemory()
        tokenizer = self.first.tokenizer
        chars = byte_characters()
        added = tokenizer.get_added_tokens_decoder()
        names = [added[i].content if i in added else tokenizer.id_to_token(i)
                 for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
        self.first_spelling = Spelling([n.encode() if i in added else bytes(chars[c] for c in n) for i, n in enumerate(names)])
        self.decimals = Spelling([str(i).encode() for i in range(max(len(names), self.second.model.get_piece_size()))])


def worker_state(byte_model: str, piece_model: bytes) -> Tokenizers:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = ("align", hashlib.sha256(byte_model.encode() + piece_model).hexdigest())
    return per_worker(key, lambda: Tokenizers(byte_model, piece_model))


def spelled(ids: np.ndarray, first: np.ndarray, spelling: Spelling, data: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which documents the ids spell byte for byte."""
    ends = np.concatenate([[0], np.cumsum(spelling.size[ids])])[first]
    good = np.diff(ends) == np.diff(docs)
    body = spelling.bytes_of(ids)
    same = T.ranges(docs[:-1], np.where(good, np.diff(docs), 0))
    own = T.ranges(ends[:-1], np.where(good, np.diff(docs), 0))
    wrong = np.concatenate([[0], np.cumsum(body[own] != data[same])])
    at = np.concatenate([[0], np.cumsum(np.where(good, np.diff(docs), 0))])
    return good & (np.diff(wrong[at]) == 0)


def terminals(first_ends: np.ndarray, second_ends: np.ndarray) -> np.ndarray:
    """For each token (first side, then second) the terminal token of its group, by pointer jumping."""
    n = len(first_ends)
    pointer = np.empty(n + len(second_ends), np.int64)
    pointer[:n] = n + np.searchsorted(second_ends, first_ends)
    back = np.searchsorted(first_ends, second_ends)
    shared = first_ends[np.minimum(back, n - 1)] == second_ends if n else np.zeros(0, bool)
    pointer[n:] = np.where(shared, n + np.arange(len(second_ends)), back)
    moving = np.arange(len(pointer))
    while len(moving):
        far = pointer[pointer[moving]]
        changed = far != pointer[moving]
        pointer[moving] = far
        moving = moving[changed]
    return pointer


class Chunk:
    """Tokens, links and groups of a chunk of whole documents."""

    def __init__(self, texts: pa.Array, tk: Tokenizers):
        data, docs = T.utf8(texts)
        sizes = np.diff(docs)
        filled = sizes > 0
        data = np.insert(data, docs[:-1][filled], 0x20)
        docs = np.concatenate([[0], np.cumsum(sizes + filled)])
        a, a_first = BT.encode_bytes(data, docs, tk.first, tk.first_memory)
        b, b_first = self.pieces(data, docs, tk)
        good = spelled(a, a_first, tk.first_spelling, data, docs) & spelled(b, b_first, tk.second.spelling, data, docs) & filled
        self.n_a, self.n_b = np.diff(a_first) * good, np.diff(b_first) * good
        self.a = a[np.repeat(good, np.diff(a_first))]
        self.b = b[np.repeat(good, np.diff(b_first))]
        a_ends, b_ends = np.cumsum(tk.first_spelling.size[self.a]), np.cumsum(tk.second.spelling.size[self.b])
        # Each cut between neighbouring ends is the overlap of one pair of tokens.
        cuts = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")  # merges the two sorted runs
        cuts = cuts[np.concatenate([[True], cuts[1:] != cuts[:-1]])] if len(cuts) else cuts
        link_a, link_b = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        self.keys = ((self.b[link_b].astype(np.uint64) * SCRAMBLE) & LOW) << np.uint64(32) | self.a[link_a].astype(np.uint64)
        a_stop = np.cumsum(self.n_a)
        self.links = np.diff(np.searchsorted(link_a, np.concatenate([[0], a_stop])))
        # Terminal tokens are of the second side; their order numbers the groups.
        n = len(self.a)
        end = terminals(a_ends, b_ends) - n
        last = np.zeros(len(self.b), np.int64)
        last[end] = 1
        group = np.cumsum(last)[end] - 1
        self.a_group, self.b_group = group[:n], group[n:]
        self.groups = np.add.reduceat(np.append(last, 0), np.cumsum(self.n_b) - self.n_b) * (self.n_b > 0)

    @staticmethod
    def pieces(data: np.ndarray, docs: np.ndarray, tk: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
        if not docs[-1]:
            return np.zeros(0, np.int32), np.zeros(len(docs), np.int64)
        blank = data[:docs[-1]] == 0x20
        head = blank.copy()
        head[1:] &= ~blank[:-1]
        head[docs[:-1][np.diff(docs) > 0]] = True
        starts = np.flatnonzero(head)
        ids, size = word_ids(data, starts, np.diff(np.append(starts, docs[-1])), tk.second_memory, tk.second.encode_words)
        before = np.concatenate([[0], np.cumsum(size)])
        return ids, before[np.searchsorted(starts, docs)]

    def texts(self, tk: Tokenizers) -> list[bytes]:
        """Groups of each document as ``a1,a2|b1;a3|b2,b3``."""
        n_groups = int(self.b_group[-1]) + 1 if len(self.b) else 0
        a_in, b_in = (np.bincount(g, minlength=n_groups) for g in (self.a_group, self.b_group))
        b_before = np.cumsum(b_in) - b_in
        a_until = np.cumsum(a_in)
        a_at = np.arange(len(self.a)) + b_before[self.a_group]
        b_at = np.arange(len(self.b)) + a_until[self.b_group]
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        sign = np.full(len(ids), ord(","), np.uint8)
        ids[a_at], ids[b_at] = self.a, self.b
        ends = np.cumsum(a_in + b_in)
        sign[ends - 1] = ord(";")
        sign[ends - b_in - 1] = ord("|")
        size = tk.decimals.size[ids]
        stop = np.cumsum(size + 1)
        out = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
        out[T.ranges(stop - size - 1, size)] = tk.decimals.bytes_of(ids)
        out[stop - 1] = sign
        tokens = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        at = np.concatenate([[0], stop])[tokens].tolist()
        return [out[x:y - 1].tobytes() if y > x else b"" for x, y in zip(at[:-1], at[1:])]


def pair_values(keys: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Twice the corpus count of each pair, plus one for the highest of its second id."""
    second = keys >> np.uint64(32)
    heads = np.flatnonzero(np.concatenate([[True], second[1:] != second[:-1]]))
    best = np.maximum.reduceat(total, heads)
    return 2 * total + (total == np.repeat(best, np.diff(np.append(heads, len(total)))))


def _block(held: list[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One row of a block: its documents, its distinct pairs, their counts."""
    keys = np.unique(np.concatenate([k for _, k, *_ in held]))
    counts, tables = np.zeros(len(keys), np.int64), []
    for table, own, link, times, sizes in held:
        place = np.searchsorted(keys, own)[link]
        counts += np.bincount(place, times, len(keys)).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)])
        gaps = np.diff(place, prepend=0)
        heads = first[:-1][sizes > 0]
        gaps[heads] = place[heads]  # a document's first pair by its number, the others by their distance
        lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int32())) for x in (gaps, times)]
        tables.append(table.append_column("link", lists[0]).append_column("times", lists[1]))
    table = pa.concat_tables(tables).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in (
        (sink.getvalue().to_pybytes(), pa.binary()), (B.pack(B.gaps(keys)), pa.binary()), (B.pack(counts), pa.binary()),
        (len(keys), pa.int64()))], ["payload", "keys", "counts", "n_keys"])


def align(documents: DataFrame, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL, id_col: str = "doc_id",
          text_col: str = "text", with_groups: bool = True, with_digests: bool = False, block_bytes: int = BLOCK_BYTES,
          range_keys: int = RANGE_KEYS, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum of every row; the groups as text; their digest."""
    definition = BT.read_model(byte_model)
    with open(piece_model, "rb") as f:
        proto = f.read()

    def figures(part: pa.RecordBatch, tk: Tokenizers):
        chunk = Chunk(T.whole(part), tk)
        columns = {"doc_id": T.column(part, "doc_id"), "n_a": chunk.n_a, "n_b": chunk.n_b, "n_groups": chunk.groups,
                   "n_links": chunk.links}
        texts = chunk.texts(tk) if with_groups or with_digests else []
        if with_groups:
            columns["groups"] = pa.array([x.decode() for x in texts], pa.string())
        if with_digests:
            columns["groups_sha256"] = pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in texts], pa.string())
        keys, place = np.unique(chunk.keys, return_inverse=True)
        doc = np.repeat(np.arange(part.num_rows), chunk.links)
        held, times = np.unique(doc * max(1, len(keys)) + place, return_counts=True)
        doc, link = np.divmod(held, max(1, len(keys)))
        return pa.table(columns), keys, link, times, np.bincount(doc, minlength=part.num_rows)

    def read(batches):
        tk = worker_state(definition, proto)
        held, size = [], 0
        for part in T.chunks(batches, limit=min(CHUNK_BYTES, block_bytes)):
            held.append(figures(part, tk))
            size += T.column(part, "text").nbytes
            if size >= block_bytes:
                yield _block(held)
                held, size = [], 0
        if held:
            yield _block(held)

    rows = keyed(documents, id_col, text_col, False).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    read_once = rows.mapInArrow(read, "payload binary, keys binary, counts binary, n_keys bigint")
    blocks, seen = stored_with(read_once.withColumn("block", F.monotonically_increasing_id()),
                               keys=F.sum("n_keys"), blocks=F.count(F.lit(1)))
    # A range holds all pairs of a second id, so there are at most 2**16 ranges.
    width = min(16, B.ranges_for(seen["keys"] or 0, range_keys))

    def request(batches):
        for batch in batches:
            for name, keys, counts in zip(*(T.column(batch, c).to_pylist() for c in ("block", "keys", "counts"))):
                yield requests(name, np.cumsum(B.unpack(keys, np.uint64)), B.unpack(counts), width)

    answers = corpus_values(blocks.select("block", "keys", "counts").mapInArrow(request, ASKED), seen["blocks"], pair_values,
                            fan_in=fan_in)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    texts = ["groups"] * with_groups + ["groups_sha256"] * with_digests

    def finish(held: pa.Table, replies: pa.Table) -> pa.Table:
        replies = replies.sort_by("part")
        values = np.concatenate([np.zeros(0, np.int64), *[B.unpack(x.as_py()) for x in replies.column("values")]])
        out = []
        for payload, n_keys in zip(held.column("payload").to_pylist(), held.column("n_keys").to_pylist()):
            if n_keys != len(values):
                raise ValueError("the counts do not fit the block's pairs")
            table = B.rows_of(payload).combine_chunks()
            link, times = (table.column(c).combine_chunks() for c in ("link", "times"))
            first = np.concatenate([[0], np.cumsum(link.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            place = np.concatenate([[0], np.cumsum(link.flatten().to_numpy().astype(np.int64))])
            place = place[1:] - np.repeat(place[first[:-1]], np.diff(first))
            value, times = values[place], times.flatten().to_numpy().astype(np.int64)

            def summed(x):
                return pa.array(np.diff(np.concatenate([[0], np.cumsum(x * times)])[first]), pa.int64())

            out.append(pa.table({**{n: table.column(n) for n in names[:5]}, "n_best": summed(value & 1),
                                 "count_sum": summed(value >> 1), **{n: table.column(n) for n in texts}}))
        return pa.concat_tables(out)

    schema = ", ".join([f"{n} bigint" for n in names] + [f"{n} string" for n in texts])
    answers = answers.select("block", "part", "values").groupBy("block")
    return blocks.select("block", "payload", "n_keys").groupBy("block").cogroup(answers).applyInArrow(finish, schema)
