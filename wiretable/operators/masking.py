"""Masked domains and shifted times: identities are hidden, relations stay.

A name's labels are replaced by salted hashes of the name from that label on, up to
the top-level label, which is kept; so names under one parent keep one masked parent.
Times are shifted by a salted offset of their flow, so order and distances inside a
flow stay while its place in time is hidden.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K

LABEL_CHARS = 12


def mask_domain(name: Column, salt: str) -> Column:
    """``h(a.x.es).h(x.es).es`` for ``a.x.es``; a single label, and a missing name, stay as they are."""
    labels = F.split(F.lower(name), "[.]")

    def masked(parts: Column) -> Column:
        n = F.size(parts)
        own = F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.left(
            F.sha2(F.concat(F.lit(salt), F.array_join(F.slice(parts, k, n), ".")), 256), F.lit(LABEL_CHARS)))
        return F.array_join(F.concat(own, F.slice(parts, n, 1)), ".")

    return F.when(F.contains(name, F.lit(".")), F.transform(F.array(labels), masked)[0]).otherwise(name)


def agent_family(agent: Column) -> Column:
    """The family of a user agent: the first whose pattern it contains, else ``Other``; a missing or empty one has none."""
    families = F.lit(K.AGENT_OTHER)
    for family, pattern in reversed(K.AGENT_FAMILIES.items()):
        families = F.when(F.lower(agent).rlike(pattern), family).otherwise(families)
    return F.when(agent != "", families)


def flow_offset(key: list[Column], salt: str, most: int) -> Column:
    """Between -most and most, the same for all rows of a flow (nulls are equal)."""
    text = F.concat_ws("|", F.lit(salt), *[F.coalesce(k.cast("string"), F.lit("\\N")) for k in key])
    number = F.conv(F.left(F.sha2(text, 256), F.lit(13)), 16, 10).cast("bigint")
    return number % (2 * most + 1) - most


def shift_times(rows: DataFrame, key: list[str], time_col: str, salt: str, most: int) -> DataFrame:
    """``time_col`` (an integer time) moved by the flow's offset."""
    return rows.withColumn(time_col, F.col(time_col) + flow_offset([F.col(k) for k in key], salt, most))


def shift_checks(before: DataFrame, after: DataFrame, key: list[str], time_col: str, id_col: str = "packet_id") -> DataFrame:
    """flows, moved_flows and broken_flows (more than one offset, so an order or a distance changed), missing_rows.

    Offsets are compared per flow by a partial aggregation: their least and greatest
    are equal where no two packets of a flow changed order or distance.
    """
    held = before.select(F.col(id_col).alias("_id"), *key, F.col(time_col).alias("_t"))
    moved = after.select(F.col(id_col).alias("_id"), F.col(time_col).alias("_s"))
    offset = F.col("_s") - F.col("_t")
    joined = held.join(moved, "_id", "left")
    flows = joined.groupBy(*key).agg(F.min(offset).alias("low"), F.max(offset).alias("high"),
                                     F.count_if(F.col("_s").isNull() & F.col("_t").isNotNull()).alias("missing"))
    return flows.agg(F.count(F.lit(1)).alias("flows"), F.count_if((F.col("low") != 0) | (F.col("high") != 0)).alias("moved_flows"),
                     F.count_if(F.col("low") != F.col("high")).alias("broken_flows"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_rows"))
