"""Attack-signal flags.

Row-level signals are plain predicates.  The port-scan signal (A1) needs a
per-source aggregate; ``count_distinct`` is planned by Spark as a two-level
aggregation (map-side dedupe of (src, port) pairs first), so a source holding
a third of all rows does not funnel its rows into one task.  The flagged
source set is joined back through ``bounded_join``: broadcast only when its
measured size is under a bound, otherwise a shuffled join that AQE can split
on skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..schema import Profile, profile as _profile
from .joins import bounded_join


def port_scanners(df: DataFrame, src: str = "src_ip", port: str = "dst_port_n",
                  min_distinct: int = K.PORT_SCAN_MIN_DISTINCT) -> DataFrame:
    """Sources contacting more than ``min_distinct`` distinct destination ports."""
    return (df.where(F.col(port).isNotNull())
            .groupBy(src).agg(F.count_distinct(port).alias("distinct_dst_ports"))
            .where(F.col("distinct_dst_ports") > min_distinct))


def _contains_any(c: Column, tokens: list[str]) -> Column:
    pattern = "|".join(t.replace(".", "[.]") for t in tokens)
    return F.coalesce(F.lower(c).rlike(pattern), F.lit(False))


def _names(pairs: list[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in pairs]))


def with_signals(df: DataFrame, prof: str | Profile, extra: dict[str, Column] | None = None,
                 broadcast_max_rows: int = 1_000_000) -> DataFrame:
    """Adds ``signals`` (array of names) and ``is_attack_pattern``.

    Expects typed ``src_port_n``, ``dst_port_n``, ``length_n`` columns.
    ``extra`` lets a caller add its own named signal columns.
    """
    prof = _profile(prof)
    c = F.col
    if prof.name == "integrated":
        scans = port_scanners(df).select("src_ip", F.lit(True).alias("_scan"))
        df = bounded_join(df, scans, ["src_ip"], "left", broadcast_max_rows)
        pairs = [
            ("port_scan", F.coalesce(c("_scan"), F.lit(False))),
            ("sensitive_port", F.coalesce(c("dst_port_n").isin(*K.SENSITIVE_PORTS), F.lit(False))),
            ("dns_query", c("dns_query").isNotNull()),
        ]
    else:
        both = c("src_port_n").isNotNull() & c("dst_port_n").isNotNull()
        pairs = [
            ("suspicious_port", both & (c("src_port_n").isin(*K.SUSPICIOUS_PORTS)
                                        | c("dst_port_n").isin(*K.SUSPICIOUS_PORTS))),
            ("high_port", both & ((c("src_port_n") > K.HIGH_PORT_ABOVE)
                                  | (c("dst_port_n") > K.HIGH_PORT_ABOVE))),
            ("unusual_packet_size", F.coalesce((c("length_n") < K.SMALL_PACKET_BELOW)
                                               | (c("length_n") > K.LARGE_PACKET_ABOVE), F.lit(False))),
            ("suspicious_dns", _contains_any(c("dns_query"), K.SUSPICIOUS_DNS_TOKENS)),
            ("suspicious_http_path", _contains_any(c("http_path"), K.SUSPICIOUS_PATH_TOKENS)),
        ]
    for name, cond in (extra or {}).items():
        pairs.append((name, F.coalesce(cond, F.lit(False))))
    out = df.withColumn("signals", _names(pairs))
    out = out.withColumn("is_attack_pattern", F.size("signals") > 0)
    return out.drop("_scan") if "_scan" in out.columns else out
