"""Corpus-wide sums of keyed counts, returned to the blocks that counted.

Each block of documents asks every key range once, with its own distinct keys and
counts in packed form.  A range adds up what the blocks say and answers each with
one value for each of its keys.  At most ``fan_in`` blocks meet in one call: with
more blocks their requests are first merged in groups, the groups' in groups
again, and the answers go down the same way.  So a key that every block holds puts
no row of every block into one task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretable.llm import blocks as B
from wiretable.llm.frames import stored

FAN_IN = 512
ASKED = "part bigint, block bigint, keys binary, counts binary"
ANSWERS = "part bigint, block bigint, values binary, n bigint, kinds bigint"


def requests(block: int, keys: np.ndarray, counts: np.ndarray, width: int) -> pa.RecordBatch:
    """A block's rows of ``ASKED`` for its sorted distinct unsigned keys; ranges are the first ``width`` bits."""
    part, heads, stops = B.by_range(keys, width)
    return pa.RecordBatch.from_arrays([
        pa.array(part), pa.array([block] * len(part), pa.int64()),
        pa.array([B.pack(B.gaps(keys[a:b])) for a, b in zip(heads, stops)], pa.binary()),
        pa.array([B.pack(counts[a:b]) for a, b in zip(heads, stops)], pa.binary())], ["part", "block", "keys", "counts"])


def _keys(table: pa.Table) -> list[np.ndarray]:
    return [np.cumsum(B.unpack(x.as_py(), np.uint64)) for x in table.column("keys")]


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, their sums, and where each row's keys stand among them."""
    keys = _keys(table)
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([B.unpack(x.as_py()) for x in table.column("counts")])
    total = np.bincount(place, counts.astype(np.float64), len(every)).astype(np.int64)  # exact below 2**53
    return every, total, np.split(place, np.cumsum([len(k) for k in keys])[:-1])


def _answers(table: pa.Table, values: list[np.ndarray], n: int, kinds: int) -> pa.Table:
    """One row for each asking row; the range's own figures stand in the first."""
    first = lambda x: pa.array([int(x)] + [0] * (table.num_rows - 1), pa.int64())
    return pa.table({"part": table.column("part"), "block": table.column("block"),
                     "values": pa.array([B.pack(v) for v in values], pa.binary()), "n": first(n), "kinds": first(kinds)})


def corpus_values(asked: DataFrame, blocks: int, value: Callable, counted: Callable | None = None,
                  fan_in: int = FAN_IN) -> DataFrame:
    """``ANSWERS`` for every row of ``asked``: ``value(keys, sums)`` at the row's keys, in their order.

    ``counted(keys)`` says which keys the figures ``n`` (their sum) and ``kinds``
    (how many have a sum above zero) are about; they are to be added up over all rows.
    """
    def top(table: pa.Table) -> pa.Table:
        keys, total, places = _merged(table)
        own = total[counted(keys)] if counted else total
        values = value(keys, total)
        return _answers(table, [values[p] for p in places], own.sum(), (own > 0).sum())

    if blocks <= fan_in:
        return asked.groupBy("part").applyInArrow(top, ANSWERS)

    def merge(table: pa.Table) -> pa.Table:
        keys, total, _ = _merged(table)
        return pa.table({"part": table.column("part")[:1], "block": table.column("node")[:1],
                         "keys": pa.array([B.pack(B.gaps(keys))], pa.binary()), "counts": pa.array([B.pack(total)], pa.binary())})

    def descend(table: pa.Table, above: pa.Table) -> pa.Table:
        keys = _keys(table)
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
        values = B.unpack(above.column("values")[0].as_py())
        if len(values) != len(every):
            raise ValueError("the answers do not fit the merged keys")
        places = np.split(place, np.cumsum([len(k) for k in keys])[:-1])
        return _answers(table, [values[p] for p in places], above.column("n")[0].as_py(), above.column("kinds")[0].as_py())

    nodes = 1 << (-(-blocks // fan_in) - 1).bit_length()
    asked = stored(asked).withColumn("node", F.pmod(F.xxhash64("block"), F.lit(nodes)).cast("bigint"))
    above = corpus_values(asked.groupBy("part", "node").applyInArrow(merge, ASKED), nodes, value, counted, fan_in)
    above = above.withColumnRenamed("block", "node").groupBy("part", "node")
    return asked.groupBy("part", "node").cogroup(above).applyInArrow(descend, ANSWERS)
