"""Outlying values per group, by z-score and by interquartile range.

The limits of a group come from its histogram (a partial aggregation: one row per
group and distinct value), so a group that holds most rows costs no task more than
its distinct values.  They are joined back to the rows.  Exact mode takes quartiles
by interpolation between values; sketch mode merges quantile sketches of bounded size
and returns values of the data, for columns with too many distinct values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import bounded_join

Z_LIMIT = 3.0
IQR_FACTOR = 1.5
#: Relative rank error of a quartile in sketch mode is at most 1 / accuracy.
ACCURACY = 1000
BROADCAST_ROWS = 1_000_000


def limits(rows: DataFrame, group: str, value: str, exact: bool = True, accuracy: int = ACCURACY) -> DataFrame:
    """group, n, total, squares (exact sums of integer values), q1, q3."""
    v = F.col("v")
    whole = "decimal(38,0)"
    if not exact:
        held = rows.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).alias("v"))
        q = F.percentile_approx("v", [0.25, 0.75], accuracy)
        out = held.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum(v.cast(whole)).alias("total"),
                                    F.sum((v.cast("bigint") * v).cast(whole)).alias("squares"), q.alias("q"))
    else:
        held = rows.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("g"), F.col(value).alias("v")).agg(
            F.count(F.lit(1)).alias("c"))
        out = held.groupBy("g").agg(F.sum("c").alias("n"), F.sum((v.cast("bigint") * F.col("c")).cast(whole)).alias("total"),
                                    F.sum((v.cast("bigint") * v * F.col("c")).cast(whole)).alias("squares"),
                                    F.percentile("v", [0.25, 0.75], F.col("c")).alias("q"))
    return out.select(F.col("g").alias(group), "n", "total", "squares", F.col("q")[0].cast("double").alias("q1"),
                      F.col("q")[1].cast("double").alias("q3"))


def outliers(rows: DataFrame, group: str, value: str, id_col: str = "packet_id", z_limit: float = Z_LIMIT,
             iqr_factor: float = IQR_FACTOR, exact: bool = True) -> DataFrame:
    """id, group, value, z, by_z, by_iqr of the rows that either test calls outlying.

    Rows without a value or a group are not judged; a group of equal values has no
    z-score (null) and no outlier.
    """
    found = limits(rows.where(F.col(group).isNotNull()), group, value, exact)
    joined = bounded_join(rows.where(F.col(value).isNotNull()), found, group, "inner", BROADCAST_ROWS)
    n, total = F.col("n").cast("double"), F.col("total").cast("double")
    spread = F.sqrt((F.col("n") * F.col("squares") - F.col("total") * F.col("total")).cast("double"))
    z = F.when(spread > 0, (F.col(value) * n - total) / spread)
    reach = iqr_factor * (F.col("q3") - F.col("q1"))
    judged = joined.select(id_col, group, value, z.alias("z"), F.coalesce(F.abs(z) > z_limit, F.lit(False)).alias("by_z"),
                           ((F.col(value) < F.col("q1") - reach) | (F.col(value) > F.col("q3") + reach)).alias("by_iqr"))
    return judged.where("by_z or by_iqr")
