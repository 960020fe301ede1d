"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_observed


def bounded_join(big: DataFrame, small: DataFrame, on: list[str], how: str,
                 max_rows: int, max_bytes: int = 64 << 20) -> DataFrame:
    """Join ``small`` to ``big``, broadcasting it only below both bounds.

    ``small`` is materialised first (reliable checkpoint), so measuring it
    does not recompute it and the join reads the stored result.  Above a
    bound the join is shuffled; AQE's skew-join handling splits a hot key on
    the big side while the matching small partition is replicated.
    """
    size = sum((F.coalesce(F.octet_length(F.col(n).cast("string")), F.lit(0)) for n in small.columns), F.lit(8))
    small, seen = materialize_observed(small, rows=F.count(F.lit(1)), size=F.sum(size))
    if seen["rows"] <= max_rows and (seen["size"] or 0) <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
