"""Token ids of documents in seekable files of independent zstandard frames.

A file is a sequence of frames, each compressed on its own, that hold the ids of
consecutive documents as little-endian unsigned 32-bit integers.  Behind them stand
two skippable frames, so that every zstandard reader gives the plain ids:

* the document index (ids, where each document ends, its own checksum);
* the seek table of the public seekable format: compressed size, plain size and
  the low 32 bits of XXH64 of the plain bytes for each frame, then the number of
  frames, a flag byte and the closing magic number.

A frame ends with the document that fills it; a longer document has frames of its
own.  So a reader finds a document by the index, the frames by the seek table, and
decompresses only these, checking each.

Documents are range partitioned by doc_id and sorted; each task encodes its range
and writes one file under a name of its own attempt.  The rows of the files that
count come back from the committed tasks alone and are written as the ``manifest``
table, so a task that was lost and run again leaves at most a file that nobody
reads.  The number of ids before each file is a running sum over the manifest (one
row per file).

Defined results: null and empty texts have only the end id; null ids come last;
rows with equal ids follow the order of the input; an empty table gives an empty
manifest and reads as no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wiretable.llm import byte_tokens as BT
from wiretable.llm import tokens as T

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
END_ID = 2
#: Plain bytes after which a frame ends with its document, and most plain bytes of any frame.
FRAME_BYTES = 256 << 10
LONGEST_FRAME = 1 << 20
LEVEL = 3
#: Most tasks that read files back.
READERS = 20_000

# Fixed values of the public zstandard formats.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

MANIFEST = "part int, file string, n_docs bigint, n_ids bigint, n_bytes bigint, first_id bigint, last_id bigint, n_null bigint"
ENTRY = np.dtype([("size", "<u4"), ("plain", "<u4"), ("check", "<u4")])


def opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    uri = re.sub("^file:/+", "/", uri)
    return (pyarrow.fs.LocalFileSystem(), uri) if uri.startswith("/") else pyarrow.fs.FileSystem.from_uri(uri)


def check_of(plain: bytes) -> int:
    return xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF


def skippable(magic: int, content: bytes) -> bytes:
    if len(content) >= 1 << 32:
        raise ValueError("a skippable frame holds less than 4 GB; write more files")
    return magic.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content


class Writer:
    """Writes documents of one file, in their order, frame by frame."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, longest: int = LONGEST_FRAME):
        self.out, self.frame_bytes, self.longest = out, frame_bytes, longest
        self.coder = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.held: list[bytes] = []
        self.held_bytes = self.n_ids = 0
        self.names: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []

    def frame(self, plain: bytes) -> None:
        body = self.coder.compress(plain)
        self.out.write(body)
        self.entries.append((len(body), len(plain), check_of(plain)))

    def flush(self) -> None:
        plain = b"".join(self.held)
        for at in range(0, len(plain), self.longest):
            self.frame(plain[at:at + self.longest])
        self.held, self.held_bytes = [], 0

    def add(self, names: np.ndarray, nulls: np.ndarray, ids: np.ndarray, first: np.ndarray) -> None:
        """Documents ``names`` (null where ``nulls``); document k has the ids ``first[k]:first[k + 1]``."""
        body = memoryview(ids.astype("<u4").tobytes())
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if self.held and self.held_bytes + 4 * (b - a) > self.longest:
                self.flush()
            self.held.append(body[4 * a:4 * b])
            self.held_bytes += 4 * (b - a)
            if self.held_bytes >= self.frame_bytes:
                self.flush()
        self.names.append(names)
        self.nulls.append(nulls)
        self.ends.append(self.n_ids + first[1:])
        self.n_ids += int(first[-1])

    def close(self) -> int:
        """Index and seek table; returns the file's size."""
        if self.held:
            self.flush()
        names, nulls, ends = (np.concatenate(x) for x in (self.names, self.nulls, self.ends))
        body = (len(names).to_bytes(8, "little") + names.astype("<i8").tobytes()
                + nulls.astype(np.uint8).tobytes() + ends.astype("<u8").tobytes())
        index = skippable(SKIPPABLE, body + xxhash.xxh64_intdigest(body).to_bytes(8, "little"))
        self.out.write(index)
        # The format lists skippable frames with an empty plain size.
        self.entries.append((len(index), 0, check_of(b"")))
        table = np.array(self.entries, ENTRY).tobytes()
        closing = len(self.entries).to_bytes(4, "little") + bytes([WITH_CHECKSUMS]) + SEEK_MAGIC.to_bytes(4, "little")
        seek = skippable(SEEK_TABLE, table + closing)
        self.out.write(seek)
        return sum(e[0] for e in self.entries) + len(seek)


class Reader:
    """A file's seek table and document index; frames are read on request."""

    def __init__(self, source, name: str = ""):
        self.source, self.name = source, name
        size = source.size()
        tail = self._bytes(size - 9, 9)
        count = int.from_bytes(tail[:4], "little")
        if int.from_bytes(tail[5:], "little") != SEEK_MAGIC or tail[4] != WITH_CHECKSUMS:
            raise ValueError(f"no seek table with checksums in {name}")
        table = size - 9 - count * ENTRY.itemsize
        entries = np.frombuffer(self._bytes(table, count * ENTRY.itemsize), ENTRY)
        self.at = np.concatenate([[0], np.cumsum(entries["size"].astype(np.int64))])
        self.plain = np.concatenate([[0], np.cumsum(entries["plain"].astype(np.int64))])
        self.check = entries["check"]
        body = self._bytes(int(self.at[-2]) + 8, int(entries["size"][-1]) - 8)
        if xxhash.xxh64_intdigest(body[:-8]) != int.from_bytes(body[-8:], "little"):
            raise ValueError(f"broken document index in {name}")
        n = int.from_bytes(body[:8], "little")
        self.names = np.frombuffer(body, "<i8", n, 8)
        self.nulls = np.frombuffer(body, np.uint8, n, 8 + 8 * n).astype(bool)
        self.ends = np.frombuffer(body, "<u8", n, 8 + 9 * n).astype(np.int64)
        self.coder = zstandard.ZstdDecompressor()
        self.last: tuple[int, bytes] = (-1, b"")

    def _bytes(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def frame(self, k: int) -> bytes:
        """Plain bytes of frame ``k``, checked against the seek table."""
        if self.last[0] != k:
            plain = self.coder.decompress(self._bytes(int(self.at[k]), int(self.at[k + 1] - self.at[k])))
            if check_of(plain) != self.check[k] or len(plain) != self.plain[k + 1] - self.plain[k]:
                raise ValueError(f"broken frame {k} in {self.name}")
            self.last = (k, plain)
        return self.last[1]

    def ids(self, begin: int, end: int) -> bytes:
        """The ids ``begin`` to ``end`` of the file as little-endian bytes, from the frames that hold them."""
        begin, end = 4 * begin, 4 * end
        parts = []
        k = int(np.searchsorted(self.plain, begin, "right")) - 1
        while begin < end:
            stop = min(end, int(self.plain[k + 1]))
            base = int(self.plain[k])
            parts.append(self.frame(k)[begin - base:stop - base])
            begin, k = stop, k + 1
        return parts[0] if len(parts) == 1 else b"".join(parts)


def write_tokens(documents: DataFrame, folder: str, model: str = MODEL, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encodes the documents into files below ``folder``; returns the manifest, one row per file."""
    definition = BT.read_model(model)
    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                            F.monotonically_increasing_id().alias("place"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("place")]
    names = [n.strip().split()[0] for n in MANIFEST.split(",")]

    def run(batches):
        from pyspark import TaskContext

        coder, memory = BT.worker_state(definition, False)
        part = TaskContext.get().partitionId()
        name = f"{part:08d}-{uuid.uuid4().hex}.ids.zst"
        writer = out = None
        ends = [None, None]
        n_docs = n_null = 0
        for batch in T.chunks(batches):
            if writer is None:
                fs, path = opened(folder)
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
                writer = Writer(out, frame_bytes)
            data, docs = T.utf8(T.whole(batch))
            ids, first = BT.encode_bytes(data, docs, coder, memory)
            n = batch.num_rows
            with_end = np.insert(ids, first[1:], end_id)
            column = T.column(batch, "doc_id")
            nulls = column.is_null().to_numpy(zero_copy_only=False)
            own = column.fill_null(0).to_numpy(zero_copy_only=False)
            writer.add(own, nulls, with_end, first + np.arange(n + 1))
            some = own[~nulls]
            if len(some):
                ends = [some[0] if ends[0] is None else ends[0], some[-1]]
            n_docs, n_null = n_docs + n, n_null + int(nulls.sum())
        if writer is not None:
            size = writer.close()
            out.close()
            row = [part, name, n_docs, writer.n_ids, size, *[None if e is None else int(e) for e in ends], n_null]
            yield pa.RecordBatch.from_pylist([dict(zip(names, row))], pa.schema([
                ("part", pa.int32()), ("file", pa.string()), *[(n, pa.int64()) for n in names[2:]]]))

    files = (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, MANIFEST))
    files.write.mode("error").parquet(f"{folder}/manifest")
    return read_manifest(documents.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files in doc_id order with ``base``, the number of ids in all files before."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _rows(folder: str, with_ids: bool, with_crc: bool):
    """Reads the requested documents (all without ``wanted``) of each file row."""
    names = ["doc_id", "start", "n_tokens"] + ["ids"] * with_ids + ["ids_crc32"] * with_crc

    def documents(name: str, base: int, wanted):
        fs, path = opened(folder)
        with fs.open_input_file(f"{path}/{name}") as source:
            reader = Reader(source, name)
            begins = np.concatenate([[0], reader.ends[:-1]]) if len(reader.ends) else reader.ends
            chosen = np.arange(len(begins)) if wanted is None else np.flatnonzero(
                ~reader.nulls & np.isin(reader.names, np.array(wanted, np.int64)))
            step = 1000
            for at in range(0, len(chosen), step):
                some = chosen[at:at + step].tolist()
                held, out = 0, []
                for k in some:
                    a, b = int(begins[k]), int(reader.ends[k])
                    body = reader.ids(a, b)
                    out.append((None if reader.nulls[k] else int(reader.names[k]), base + a, b - a,
                                *([np.frombuffer(body, "<u4").astype(np.int32)] if with_ids else []),
                                *([zlib.crc32(body)] if with_crc else [])))
                    held += len(body) if with_ids else 0
                    if held > T.CHUNK_BYTES:
                        yield batch(out)
                        held, out = 0, []
                if out:
                    yield batch(out)

    def batch(out):
        kinds = [pa.int64()] * 3 + [pa.list_(pa.int32())] * with_ids + [pa.int64()] * with_crc
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names)

    schema = ", ".join(f"{n} {'array<int>' if n == 'ids' else 'bigint'}" for n in names)
    return documents, schema


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True, with_crc: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, the ids and their crc32, read from the files."""
    documents, schema = _rows(folder, with_ids, with_crc)
    files = read_manifest(spark, folder).select("file", "base")
    tasks = min(max(1, spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").count()), READERS)

    def run(batches):
        for b in batches:
            for name, base in zip(T.column(b, "file").to_pylist(), T.column(b, "base").to_pylist()):
                yield from documents(name, base, None)

    return files.repartition(tasks).mapInArrow(run, schema)


def read_documents(spark: SparkSession, folder: str, wanted: DataFrame, id_col: str = "doc_id", with_crc: bool = False) -> DataFrame:
    """The requested documents alone, from the frames that hold them (ids that no file has give no row).

    The files' id ranges (one row per file) go to the tasks that deal the requests.
    """
    documents, schema = _rows(folder, True, with_crc)
    files = [r for r in read_manifest(spark, folder).orderBy("part").collect() if r.first_id is not None]
    first = np.array([r.first_id for r in files], np.int64)
    last = np.array([r.last_id for r in files], np.int64)
    where = [(r.file, r.base) for r in files]

    def deal(batches):
        for b in batches:
            ids = T.column(b, "doc_id").to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(last, ids, "left"), np.searchsorted(first, ids, "right")
            sizes = np.maximum(high - low, 0)
            yield pa.RecordBatch.from_arrays([pa.array(T.ranges(low, sizes), pa.int64()), pa.array(np.repeat(ids, sizes), pa.int64())],
                                             ["at", "doc_id"])

    def run(group: pa.Table) -> pa.Table:
        name, base = where[group.column("at")[0].as_py()]
        found = list(documents(name, base, group.column("doc_id").to_numpy()))
        return pa.Table.from_batches(found) if found else empty

    kinds = {"array<int>": pa.list_(pa.int32()), "bigint": pa.int64()}
    empty = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))]).empty_table()
    asked = wanted.select(F.col(id_col).cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    return asked.mapInArrow(deal, "at bigint, doc_id bigint").groupBy("at").applyInArrow(run, schema)
