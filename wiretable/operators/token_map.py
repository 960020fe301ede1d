"""Reversible pseudonyms: a map from values to dense tokens that grows over loads.

A load's unknown values (an anti-join with the map) are written once, each with its
partition and its place in it.  The partitions' sizes, one row per partition, become
offsets, so tokens are dense without a global sort or a single task.  Tokens go on
behind the map's largest; old ones never change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import bounded_join
from ..functions.fields import is_missing
from ..session import materialize

BROADCAST_ROWS = 1_000_000
#: Bits that monotonically_increasing_id gives to the place in a partition.
PLACE_BITS = 33


def grow(known: DataFrame | None, values: DataFrame, column: str = "value") -> DataFrame:
    """value, token: the map ``known`` (none at the first load) with the new values of ``column``; missing ones have no token."""
    new = values.select(F.col(column).alias("value")).where(~is_missing(F.col("value"))).distinct()
    first = F.lit(0).cast("bigint")
    if known is not None:
        new = new.join(known.select("value"), "value", "left_anti")
        top = known.agg(F.max("token")).first()[0]
        first = F.lit(0 if top is None else top + 1).cast("bigint")
    row = F.monotonically_increasing_id()
    held = materialize(new.select("value", F.shiftright(row, PLACE_BITS).alias("part"), row.bitwiseAND((1 << PLACE_BITS) - 1).alias("place")))
    sizes = held.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    grown = bounded_join(held, offsets, "part", "inner", BROADCAST_ROWS).select(
        "value", (first + F.col("offset") + F.col("place")).alias("token"))
    return materialize(grown if known is None else known.select("value", "token").unionByName(grown))


def replace(rows: DataFrame, mapping: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as tokens (missing values: null); a value that the map lacks fails the job."""
    for c in columns:
        known = mapping.select(F.col("value").alias(c), F.col("token").alias("_token"))
        lost: Column = F.raise_error(F.lit(f"a value of {c} has no token"))
        token = F.when(F.col("_token").isNotNull(), F.col("_token")).when(is_missing(F.col(c)), F.lit(None)).otherwise(lost)
        rows = bounded_join(rows, known, c, "left", BROADCAST_ROWS).withColumn(c, token.cast("bigint")).drop("_token")
    return rows


def restore(rows: DataFrame, mapping: DataFrame, columns: list[str]) -> DataFrame:
    """The values that the tokens stand for."""
    for c in columns:
        known = mapping.select(F.col("token").alias(c), F.col("value").alias("_value"))
        rows = bounded_join(rows, known, c, "left", BROADCAST_ROWS).withColumn(c, F.col("_value")).drop("_value")
    return rows
