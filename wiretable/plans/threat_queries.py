"""Registered queries of the threat and privacy operators, over the packet view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import fields as X
from ..operators.bursts import brute_force_bursts
from ..operators.indicators import indicator_match
from ..operators.masking import agent_family, mask_domain, shift_checks, shift_times
from ..operators.outliers import outliers
from ..operators.sketches import daily_sketches, distinct_between
from ..operators.token_map import grow, replace, restore
from ..session import materialize
from ..sources.packets import packets

#: Connection attempts within this time (in microseconds) and from this number on count as a burst.
BURST_WINDOW = 300_000_000
BURST_LEAST = 3
#: Flows are moved by at most a day.
SHIFT_MOST = 86_400_000_000

# Address blocks, ranges and domains that the packets themselves give, so that their number grows with them.
INDICATORS = """
SELECT DISTINCT 'address' AS kind, concat(dst_ip, '/32') AS indicator FROM {pk}
WHERE dst_ip LIKE '203.0.113.%' AND CAST(regexp_extract(dst_ip, '([0-9]+)$', 1) AS INT) % 3 = 0
UNION SELECT DISTINCT 'address', concat(regexp_extract(dst_ip, '^([0-9]+[.][0-9]+[.][0-9]+[.])', 1), '0/24') FROM {pk} WHERE dst_ip LIKE '2%'
UNION SELECT DISTINCT 'address', concat(src_ip, '-10.0.2.', CAST(CAST(regexp_extract(src_ip, '([0-9]+)$', 1) AS INT) + 6 AS VARCHAR(20)))
FROM {pk} WHERE src_ip LIKE '10.0.2.%' AND CAST(regexp_extract(src_ip, '([0-9]+)$', 1) AS INT) % 10 = 3
UNION SELECT DISTINCT 'address', concat(src_ip, '/64') FROM {pk} WHERE src_ip LIKE '%:%'
UNION SELECT 'address', '10.0.2.0/26' UNION SELECT 'address', '999.1.2.3/8' UNION SELECT 'address', '10.0.2.0/40'
UNION SELECT DISTINCT 'domain', dns_query FROM {pk} WHERE dns_query LIKE '%0.example.com'
UNION SELECT DISTINCT 'domain', regexp_extract(dns_query, '[.](.*)$', 1) FROM {pk} WHERE dns_query IS NOT NULL
"""

FLOW = ["src_ip", "dst_ip", "src_port", "dst_port"]


def indicator_match_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    pk = packets(spark, sf_dir)
    return indicator_match(pk, materialize(spark.sql(INDICATORS, pk=pk)))


def brute_force_q(spark, sf_dir):
    return brute_force_bursts(packets(spark, sf_dir), BURST_WINDOW, BURST_LEAST)


def typed_lengths(spark, sf_dir) -> DataFrame:
    pk = packets(spark, sf_dir)
    return pk.select("packet_id", X.protocol_label_modular(F.col("ip_proto")).alias("protocol"),
                     F.expr("cast(try_cast(trim(length) as double) as int)").alias("length"))


def length_outliers(spark, sf_dir):
    return outliers(typed_lengths(spark, sf_dir), "protocol", "length")


def token_map_growth(spark, sf_dir):
    """Two loads, the second holding all packets: what the map keeps and restores."""
    pk = packets(spark, sf_dir)
    ends = pk.select("packet_id", F.explode(F.array("src_ip", "dst_ip")).alias("value"))
    first = grow(None, ends.where("packet_id % 2 = 0"))
    second = grow(first, ends)
    rows = pk.select("packet_id", "src_ip", "dst_ip")
    back = restore(replace(rows, second, ["src_ip", "dst_ip"]), second, ["src_ip", "dst_ip"])
    same = rows.alias("a").join(back.alias("b"), "packet_id").where(
        F.col("a.src_ip").eqNullSafe(F.col("b.src_ip")) & F.col("a.dst_ip").eqNullSafe(F.col("b.dst_ip")))
    kept = first.join(second, ["value", "token"], "left_semi")
    figures = second.agg(F.count(F.lit(1)).alias("tokens"), F.count_distinct("token").alias("distinct_tokens"),
                         F.min("token").alias("lowest"), F.max("token").alias("highest"))
    # Each side is one row.
    return (figures.withColumn("k", F.lit(1)).join(kept.agg(F.count(F.lit(1)).alias("kept_tokens")).withColumn("k", F.lit(1)), "k")
            .join(same.agg(F.count(F.lit(1)).alias("restored_rows")).withColumn("k", F.lit(1)), "k").drop("k"))


def masked_domains(spark, sf_dir):
    pk = packets(spark, sf_dir).where("dns_query is not null")
    return pk.select("packet_id", mask_domain(F.col("dns_query"), K.PUBLISHED_SALT).alias("masked"))


def agent_families(spark, sf_dir):
    """Every packet with its agent's family in place of the agent."""
    return packets(spark, sf_dir).select("packet_id", agent_family(F.col("user_agent")).alias("agent_family"))


def shifted_times(spark, sf_dir):
    return shift_times(packets(spark, sf_dir).select("packet_id", "t_us", *FLOW), FLOW, "t_us", K.PUBLISHED_SALT, SHIFT_MOST)


def time_shift_checks(spark, sf_dir):
    pk = materialize(packets(spark, sf_dir).select("packet_id", "t_us", *FLOW))
    return shift_checks(pk, materialize(shift_times(pk, FLOW, "t_us", K.PUBLISHED_SALT, SHIFT_MOST)), FLOW, "t_us")


def sketched_endpoints(spark, sf_dir):
    """Distinct endpoints of all dates by merged sketches: exact counts, and whether the estimates lie within 5 %."""
    pk = packets(spark, sf_dir).withColumn("day", F.expr("t_us div 86400000000"))
    held = materialize(daily_sketches(pk, "day", ["src_ip", "dst_ip"]))
    est = distinct_between(held, "day", ["src_ip", "dst_ip"])
    exact = pk.agg(F.count_distinct("src_ip").alias("src"), F.count_distinct("dst_ip").alias("dst"))
    both = est.withColumn("k", F.lit(1)).join(exact.withColumn("k", F.lit(1)), "k")
    return both.select("days", F.col("src").alias("distinct_src"), F.col("dst").alias("distinct_dst"),
                       *[(F.abs(F.col(c) - F.col(c[:3])) <= 0.05 * F.col(c[:3])).alias(f"{c[:3]}_within") for c in ("src_ip", "dst_ip")])


THREAT_QUERIES = {
    "indicator_match": indicator_match_q,
    "brute_force_bursts": brute_force_q,
    "length_outliers": length_outliers,
    "token_map_growth": token_map_growth,
    "masked_domains": masked_domains,
    "agent_families": agent_families,
    "shifted_times": shifted_times,
    "time_shift_checks": time_shift_checks,
    "sketched_endpoints": sketched_endpoints,
}
