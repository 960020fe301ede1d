"""Second access path of the packet table: rows clustered along a Z-order key (K6).

The table of ``tables.write_table`` is sorted by destination first, so that a lookup
by source, port or flow reads every file of a date.  Here each column gets a rank of
few bits, the ranks' bits are interleaved, and files hold ranges of the interleaved
key: the minima and maxima of every column are then narrow in every row group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bind

#: Bits of a column's rank: 64 ranks of about equal numbers of rows.
BITS = 6
#: Accuracy of the quantile sketches (relative rank error 1 / accuracy).
ACCURACY = 10_000
ROWS_PER_FILE = 4_000_000
_LEAST = "-9223372036854775807L"


def order_number(column: Column, kind: T.DataType) -> Column:
    """A number in the order of the values; texts by their first seven bytes, NULL before all.

    Pseudonyms differ within these bytes; texts that share them get one rank.
    """
    if isinstance(kind, T.StringType):
        head = F.hex(F.substring(F.encode(column, "utf-8"), 1, 7))
        number = F.conv(F.rpad(head, 14, "0"), 16, 10).cast("bigint")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(column)
    else:
        number = column.cast("bigint")
    return F.coalesce(number, F.expr(_LEAST))


def rank_cuts(quantiles: list[int]) -> list[int]:
    """Where ranks begin: at each quantile, and behind a value that fills several of them."""
    values = sorted(quantiles)
    repeated = {a for a, b in zip(values, values[1:]) if a == b}
    return sorted({*values, *(v + 1 for v in repeated)})


def spread_bits(rank: int, place: int, columns: int, bits: int = BITS) -> int:
    """A rank's bits, ``columns`` apart, from bit ``place`` on."""
    return sum(((rank >> k) & 1) << (k * columns + place) for k in range(bits))


def _search(name: str, cuts: list[int], leaves: list[int]) -> str:
    """The leaf of a value by binary search over the cuts, as nested conditions."""
    if not cuts:
        return f"{leaves[0]}L"
    k = len(cuts) // 2
    return f"if({name} < {cuts[k]}L, {_search(name, cuts[:k], leaves[:k + 1])}, {_search(name, cuts[k + 1:], leaves[k + 1:])})"


def with_z_key(df: DataFrame, columns: list[str], bits: int = BITS, accuracy: int = ACCURACY) -> tuple[DataFrame, int]:
    """Adds ``_z``, the interleaved ranks of ``columns``; also returns the number of rows.

    The quantiles of all columns come from one partial aggregation of bounded sketches.
    """
    numbers = {f"_n{k}": order_number(F.col(c), df.schema[c].dataType) for k, c in enumerate(columns)}
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = df.select(*[c.alias(n) for n, c in numbers.items()]).agg(
        F.count(F.lit(1)).alias("rows"), *[F.percentile_approx(n, shares, accuracy).alias(n) for n in numbers]).first()
    z = F.lit(0).cast("bigint")
    for place, name in enumerate(numbers):
        cuts = rank_cuts(found[name] or [])
        leaves = [spread_bits((k << bits) // (len(cuts) + 1), place, len(columns), bits) for k in range(len(cuts) + 1)]
        z = z.bitwiseOR(F.expr(_search(name, cuts, leaves)))
    return bind(bind(df, **numbers), _z=z).drop(*numbers), found["rows"]


def write_clustered(df: DataFrame, name: str, columns: list[str], id_col: str = "packet_id", rows_per_file: int = ROWS_PER_FILE,
                    path: str | None = None, row_group_bytes: int | None = None) -> int:
    """Writes ``df`` (a stored table, read three times) as table ``name``, clustered by ``columns``.

    Files are ranges of the key from sampled bounds.  Rows of one key, as of a flow with most of the
    packets, are dealt further by a hash of ``id_col``, so no key makes a file larger than
    others.  An empty table gives an empty one.  Returns the number of rows; raises when the
    table holds another number.
    """
    keyed, rows = with_z_key(df, columns)
    files = max(1, -(-rows // rows_per_file))
    out = (keyed.withColumn("_salt", F.xxhash64(id_col)).repartitionByRange(files, "_z", "_salt")
           .sortWithinPartitions("_z", *columns).drop("_z", "_salt"))
    writer = out.write.mode("overwrite").format("parquet")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    loaded = df.sparkSession.table(name).count()
    if loaded != rows:
        raise AssertionError(f"load count mismatch: {rows} rows read, {loaded} in table {name}")
    return loaded
