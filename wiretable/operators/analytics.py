"""The six traffic queries (Q1-Q6) and the service label.

Top-k queries sort by count and then by the group key, so ties at the cut
are deterministic; ``orderBy().limit()`` plans as TakeOrderedAndProject (a
per-partition top-k, then a merge of k rows per partition).  Ratios are
computed with exact integer arithmetic and one final division, so results
do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K

TOP_K = K.REPORT_TOP_K


def service_label(port: Column) -> Column:
    expr = None
    for p, label in K.SERVICE_LABELS.items():
        expr = F.when(port == p, label) if expr is None else expr.when(port == p, label)
    return expr.otherwise(K.SERVICE_OTHER)


def q1_total(t: DataFrame) -> DataFrame:
    return t.agg(F.count(F.lit(1)).alias("total_records"))


def q2_top_destinations(t: DataFrame, dst_col: str = "dst_ip_anon", k: int = TOP_K) -> DataFrame:
    return (t.groupBy(dst_col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first(dst_col)).limit(k))


def q3_top_domains(t: DataFrame, k: int = TOP_K) -> DataFrame:
    return (t.where(F.col("dns_query").isNotNull() & (F.col("dns_query") != ""))
            .groupBy("dns_query").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("dns_query")).limit(k))


def q4_top_ports(t: DataFrame, k: int = TOP_K) -> DataFrame:
    return (t.where(F.col("dst_port").isNotNull())
            .groupBy("dst_port").agg(F.count(F.lit(1)).alias("count"))
            .withColumn("service_type", service_label(F.col("dst_port")))
            .orderBy(F.desc("count"), F.asc("dst_port")).limit(k))


def q5_length_stats(t: DataFrame) -> DataFrame:
    return (t.where(F.col("length").isNotNull())
            .agg(F.sum(F.col("length").cast("long")).alias("_s"), F.count("length").alias("_n"),
                 F.max("length").alias("max_length"), F.min("length").alias("min_length"))
            .select((F.col("_s") / F.col("_n")).alias("avg_length"), "max_length", "min_length",
                    F.expr("_s div _n").alias("avg_length_int")))


def q6_protocol_share(t: DataFrame) -> DataFrame:
    """Count and share per protocol; the total is the sum of the few groups.

    The rows are grouped once, the NULL protocol included; the share is rounded
    half-up to 2 decimals with integer arithmetic.
    """
    groups = t.groupBy("protocol").agg(F.count(F.lit(1)).alias("count"))
    total = groups.agg(F.sum("count")).scalar()
    hundredths = F.expr("(count * 20000 + _total) div (_total * 2)")
    return (groups.withColumn("_total", total).where(F.col("protocol").isNotNull())
            .select("protocol", "count", (hundredths / F.lit(100)).alias("percentage"))
            .orderBy(F.desc("count"), F.asc("protocol")))


def service_share(t: DataFrame) -> DataFrame:
    """Count and share of all packets per service of the destination port; packets without a port are ``Other``."""
    groups = t.groupBy(service_label(F.col("dst_port")).alias("service_type")).agg(F.count(F.lit(1)).alias("count"))
    total = groups.agg(F.sum("count")).scalar()
    hundredths = F.expr("(count * 20000 + _total) div (_total * 2)")
    return (groups.withColumn("_total", total).select("service_type", "count", (hundredths / F.lit(100)).alias("percentage"))
            .orderBy(F.desc("count"), F.asc("service_type")))


def large_packets(t: DataFrame, most: int = K.LARGE_PACKET_BYTES) -> DataFrame:
    """Packets of more than ``most`` bytes (a filter that reaches the scan); rows without a length are not among them."""
    return t.where(F.col("length") > most)


QUERIES = {
    "q1_total": q1_total,
    "q2_top_destinations": q2_top_destinations,
    "q3_top_domains": q3_top_domains,
    "q4_top_ports": q4_top_ports,
    "q5_length_stats": q5_length_stats,
    "q6_protocol_share": q6_protocol_share,
}
