"""Rows packed into blocks of bounded size, and compact arrays of numbers.

A block is one row that holds many rows as a compressed Arrow stream.  The
blocks are written once under ``spark.checkpoint.dir``, so that several passes
see the same blocks under the same numbers, whatever is recomputed meanwhile.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretable.llm import tokens as T
from wiretable.llm.frames import stored


def in_blocks(rows: DataFrame, text_col: str = "text", limit: int = 6 << 20, level: int = 1) -> DataFrame:
    """block (a number), payload and n_bytes (of text); every block holds about ``limit`` bytes of text.

    ``level``: zstd's effort, worth more where blocks are shuffled several times.
    """
    names = rows.columns

    def run(batches):
        held, size = [], 0
        for part in T.chunks(batches, text_col, min(T.CHUNK_BYTES, limit // 2)):
            held.append(part)
            size += T.column(part, text_col).nbytes
            if size >= limit:
                yield block(held)
                held, size = [], 0
        if held:
            yield block(held)

    def block(parts):
        sink = pa.BufferOutputStream()
        table = pa.Table.from_batches(parts).combine_chunks()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", level))) as out:
            out.write_table(table)
        texts = table.column(names.index(text_col))
        return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                                           pa.array([texts.nbytes], pa.int64())], ["payload", "n_bytes"])

    packed = rows.mapInArrow(run, "payload binary, n_bytes bigint")
    return stored(packed.withColumn("block", F.monotonically_increasing_id()))


def rows_of(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def pack(values: np.ndarray) -> bytes:
    """Byte planes of 64-bit numbers, compressed."""
    planes = np.ascontiguousarray(values.astype(np.int64, copy=False).view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes, kind: type = np.int64) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(kind).reshape(n)


def gaps(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted unsigned keys; ``np.cumsum`` gives the keys again."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.int64)


def by_range(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key ranges (the first ``width`` bits) of sorted unsigned keys: numbers, starts, ends."""
    if not len(keys):
        return (np.zeros(0, np.int64),) * 3
    part = (keys >> np.uint64(64 - width)).astype(np.int64) if width else np.zeros(len(keys), np.int64)
    heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    return part[heads], heads, np.append(heads[1:], len(part))


def ranges_for(size: int, per_range: int) -> int:
    """Bits of the key that make ranges of about ``per_range`` bytes of ``size``."""
    return max(0, (-(-int(size) // per_range) - 1).bit_length())
