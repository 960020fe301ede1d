"""Bursts: the most packets of a key in any time window.

The packets in the window that ends at a packet are counted without gathering a key.
Time is cut into slices of 1/64 window, so a time one window earlier lies exactly 64
slices earlier.  The count is that of the 64 slices before the packet's, plus those of
its own slice up to it, minus those that are too old in the first of the 64: these are
moved one window ahead, stand in the packet's own slice, and count negatively.  Frames
are partitioned by key and slice, and slice totals by key and window, so a key that
holds most packets is spread over its time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

SLICES = 64


def bursts(events: DataFrame, key: list[str], time_col: str, window: int) -> DataFrame:
    """key columns, events, most, at: events of the key, the most in a window, and the first time it ends with so many.

    Times are integers; the window that ends at ``t`` holds the times above ``t - window``
    up to ``t``.  Rows without a time are left out; nulls in the key are equal.
    """
    t = F.col(time_col).cast("bigint")
    at = events.where(t.isNotNull()).groupBy(*key, t.alias("t")).agg(F.count(F.lit(1)).alias("n"))
    at = materialize(at.withColumn("slice", F.expr(
        f"(t - pmod(t, {window})) div {window} * {SLICES} + pmod(t, {window}) * {SLICES} div {window}")))
    old = at.select(*key, (F.col("t") + window).alias("t"), F.lit(0).cast("bigint").alias("n"),
                    (F.col("slice") + SLICES).alias("slice"), (-F.col("n")).alias("weight"))
    running = W.partitionBy(*key, "slice").orderBy("t").rangeBetween(W.unboundedPreceding, 0)
    placed = at.withColumn("weight", F.col("n")).unionByName(old).withColumn("inside", F.sum("weight").over(running)).where("n > 0")
    # Slice totals stand in their own window and, for its slices, in the next.
    totals = at.groupBy(*key, "slice").agg(F.sum("n").alias("total"))
    both = totals.withColumn("span", F.explode(F.array(F.expr(f"floor(slice / {SLICES})"), F.expr(f"floor(slice / {SLICES}) + 1"))))
    earlier = W.partitionBy(*key, "span").orderBy("slice").rangeBetween(-SLICES, -1)
    before = both.withColumn("before", F.coalesce(F.sum("total").over(earlier), F.lit(0))).where(f"span = floor(slice / {SLICES})")
    before = before.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("slice").alias("_slice"), "before")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key], F.col("slice") == F.col("_slice"))
    counted = placed.join(before, same).withColumn("count", F.col("inside") + F.col("before"))
    best = F.max(F.struct("count", (-F.col("t")).alias("m")))
    return counted.groupBy(*key).agg(F.sum("n").alias("events"), best.alias("best")).select(
        *key, "events", F.col("best.count").alias("most"), (-F.col("best.m")).alias("at"))


def brute_force_bursts(packets: DataFrame, window: int, least: int, time_col: str = "t_us") -> DataFrame:
    """Source, destination and port with at least ``least`` packets in some window (repeated connection attempts)."""
    found = bursts(packets, ["src_ip", "dst_ip", "dst_port"], time_col, window)
    return found.where(F.col("most") >= least)
