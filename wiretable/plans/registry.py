"""Registered queries: one per operator family, each ``(spark, sf_dir) -> DataFrame``.

All of them read the driver's tables (the packet view is derived from
``events``; the leak scans read ``documents``, ``pages`` and
``conversations``), so their work grows with the data.  Output columns are
named identically to the DuckDB oracles in ``plans.oracles``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import fields as X
from ..functions.addresses import DOTTED_QUAD_PATTERN, is_internal, octets
from ..operators import analytics as Q
from ..operators import profiling as G
from ..operators.anonymize import hash_metrics, pseudonym_checks, pseudonymize
from ..operators.dedup import drop_exact, first_per_key, thin_flows
from ..operators.normalize import normalize
from ..operators.quality import with_reject_reason
from ..operators.relevance import with_relevance
from ..operators.signals import port_scanners, with_signals
from ..schema import INTEGRATED, MODULAR, RAW13_FIELDS, RAW16_FIELDS, Profile
from ..session import Workspace, bind, ensure_checkpoint_dir, materialize
from ..sources.exports import read_export, read_stage
from ..sources.packets import packets
from .clustering import write_clustered
from .pipeline import clean, clean_counters, extract, validate
from .tables import load_checks, write_load, write_stage, write_table
from .threat_queries import THREAT_QUERIES

# Parity tests and the golden pseudonyms use the published salt (a fixed value).
PUBLISHED_SALT = K.PUBLISHED_SALT

TEXT_COLUMNS = ["frame_time", "src_ip", "dst_ip", "ip_proto", "src_port", "dst_port",
                "length", "dns_query", "http_host", "http_path", "user_agent"]


# ------------------------------------------------------------------ building blocks


def extracted(spark: SparkSession, sf_dir: str, prof: Profile) -> DataFrame:
    """The profile's extraction of the exported packet view."""
    return extract(raw_export(spark, sf_dir), prof).extracted


def cleaned(spark: SparkSession, sf_dir: str, prof: Profile):
    return clean(extracted(spark, sf_dir, prof), prof)


_LOADED: dict[tuple, DataFrame] = {}


def loaded_table(spark: SparkSession, sf_dir: str, prof: Profile) -> DataFrame:
    """The profile's pseudonymised table: built once per session and folder, then read by every report."""
    key = (spark.sparkContext.applicationId, sf_dir, prof.name)
    if key not in _LOADED:
        workspace = Workspace(spark)
        with workspace:
            c = cleaned(spark, sf_dir, prof).clean
            anonymised = pseudonymize(c, prof, PUBLISHED_SALT)
        _LOADED[key] = materialize(anonymised)
        workspace.close()
    return _LOADED[key]


def network_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_table(spark, sf_dir, INTEGRATED)


def network_traffic_modular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_table(spark, sf_dir, MODULAR)


def _cleaned_output(df: DataFrame) -> DataFrame:
    return df.select("packet_id", "event_ns", "src_ip", "dst_ip", "protocol", "src_port",
                     "dst_port", "length", "dns_query", "http_host", "http_path", "user_agent",
                     F.array_join("signals", ",").alias("signals"), "is_attack_pattern")


def raw_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 16-field export derived from the packet view (IPv6 addresses and the
    protocol number go to the IPv6 columns; ports to the TCP or UDP fields),
    with quoted agents, repeated addresses and ports, and blank edges injected.
    """
    pk = packets(spark, sf_dir)
    pid = F.col("packet_id")

    def where(every: int, changed: Column, plain: Column) -> Column:
        return F.when(pid % every == 0, changed).otherwise(plain)

    src = where(83, F.concat("src_ip", F.lit(",10.0.2.254")), F.col("src_ip"))
    dport = where(71, F.concat("dst_port", F.lit(",9")), F.col("dst_port"))
    v6_src = F.col("src_ip").contains(":")
    v6_dst = F.col("dst_ip").contains(":")
    tcp = F.col("ip_proto") == "6"
    udp = F.col("ip_proto") == "17"
    e = F.lit("")
    cols = {
        "frame.time": F.col("frame_time"),
        "ip.src": F.when(v6_src, e).otherwise(src),
        "ipv6.src": F.when(v6_src, src).otherwise(e),
        "ip.dst": F.when(v6_dst, e).otherwise(F.col("dst_ip")),
        "ipv6.dst": F.when(v6_dst, F.col("dst_ip")).otherwise(e),
        "ip.proto": F.when(v6_src, e).otherwise(F.col("ip_proto")),
        "ipv6.nxt": F.when(v6_src, F.col("ip_proto")).otherwise(e),
        "tcp.srcport": F.when(tcp, F.col("src_port")).otherwise(e),
        "tcp.dstport": F.when(tcp, dport).otherwise(e),
        "udp.srcport": F.when(udp, F.col("src_port")).otherwise(e),
        "udp.dstport": F.when(udp, dport).otherwise(e),
        "frame.len": F.col("length"),
        "dns.qry.name": F.col("dns_query"),
        "http.host": where(73, F.concat(F.lit(" "), "http_host", F.lit("  ")), F.col("http_host")),
        "http.request.uri": F.col("http_path"),
        "http.user_agent": where(79, F.concat(F.lit('"'), "user_agent", F.lit('"')), F.col("user_agent")),
    }
    hour = F.date_format(F.expr("timestampadd(MICROSECOND, t_us, TIMESTAMP_NTZ'1970-01-01 00:00:00')"),
                         "yyyyMMddHHmm")
    return pk.select("packet_id", *[cols[f].alias(f) for f in RAW16_FIELDS],
                     F.concat(F.lit("capture_"), hour, F.lit(".tsv")).alias("source_file"))


# -------------------------------------------------------------------------- queries


def _q(name):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = network_traffic(spark, sf_dir)
        if name == "q2_top_destinations":
            return Q.q2_top_destinations(t, "dst_ip_anonimizada")
        return Q.QUERIES[name](t)
    return run


def protocol_labels(spark, sf_dir):
    pk = packets(spark, sf_dir)
    return pk.select("packet_id", "ip_proto",
                     X.protocol_label_integrated(F.col("ip_proto")).alias("label_integrated"),
                     X.protocol_label_modular(F.col("ip_proto")).alias("label_modular"))


def _normalize(prof: Profile):
    def run(spark, sf_dir):
        out = normalize(raw_export(spark, sf_dir), prof)
        return out.select("packet_id", "source_file", "timestamp", "src_ip", "dst_ip", "protocol",
                          "src_port", "dst_port", "length", "dns_query", "http_host", "http_path",
                          "user_agent")
    return run


def timestamp_parse(spark, sf_dir):
    pk = packets(spark, sf_dir)
    a = X.parse_time_integrated(F.col("frame_time"))
    b = X.parse_time_modular(F.col("frame_time"))
    return pk.select("packet_id",
                     X.time_ns(a, X.time_text_integrated(F.col("frame_time"))).alias("ns_integrated"),
                     X.time_ns(b, X.time_text_modular(F.col("frame_time"))).alias("ns_modular"))


def relevance_rules(spark, sf_dir):
    pk = packets(spark, sf_dir)
    df = pk.select("packet_id", *[X.blank_to_null(F.col(c)).alias(c) for c in TEXT_COLUMNS])
    return with_relevance(df).select("packet_id", "relevance_rule", "relevant")


def internal_split(spark, sf_dir):
    pk = bind(packets(spark, sf_dir), s=octets(F.col("src_ip")), d=octets(F.col("dst_ip")))
    return pk.select("packet_id", is_internal(F.col("s")).alias("src_internal"), is_internal(F.col("d")).alias("dst_internal"))


def _rejects(prof: Profile):
    def run(spark, sf_dir):
        pk = packets(spark, sf_dir)
        label = X.protocol_label_integrated if prof.name == "integrated" else X.protocol_label_modular
        df = pk.select("packet_id", *[X.blank_to_null(F.col(c)).alias(c) for c in TEXT_COLUMNS])
        df = df.withColumn("protocol", label(F.col("ip_proto"))).withColumnRenamed("frame_time", "timestamp")
        return with_reject_reason(df, prof).select(
            "packet_id", F.coalesce("reject_reason", F.lit("ok")).alias("reason"))
    return run


def port_scanners_q(spark, sf_dir):
    pk = packets(spark, sf_dir)
    return port_scanners(pk.withColumn("dst_port_n", X.port_value(F.col("dst_port"))))


def _signals(prof: Profile):
    def run(spark, sf_dir):
        df = extracted(spark, sf_dir, prof)
        checked = with_reject_reason(df, prof).where(F.col("reject_reason").isNull())
        return with_signals(checked, prof).select(
            "packet_id", F.array_join("signals", ",").alias("signals"), "is_attack_pattern")
    return run


def exact_dedup(spark, sf_dir):
    pk = packets(spark, sf_dir)
    return drop_exact(pk, [c for c in pk.columns if c != "packet_id"])


def first_per_tuple(spark, sf_dir):
    pk = packets(spark, sf_dir)
    return first_per_key(pk, ["src_ip", "dst_ip", "src_port", "dst_port"], ["t_us"]) \
        .select("src_ip", "dst_ip", "src_port", "dst_port", "packet_id", "t_us")


def _thin(window_s: int, with_protocol: bool):
    def run(spark, sf_dir):
        pk = packets(spark, sf_dir)
        key = ["src_ip", "dst_ip"] + (["ip_proto"] if with_protocol else []) + ["src_port", "dst_port"]
        return thin_flows(pk, key, "t_us", window_s * 1_000_000) \
            .select("packet_id", "src_ip", "dst_ip", "ip_proto", "src_port", "dst_port", "t_us")
    return run


def _pseudonyms(salt_first: bool):
    def run(spark, sf_dir):
        pk = packets(spark, sf_dir)
        ips = pk.select(F.col("src_ip").alias("ip")).union(pk.select(F.col("dst_ip").alias("ip"))) \
            .where(~X.is_missing(F.col("ip"))).distinct()
        return ips.select("ip", X.pseudonym(F.col("ip"), PUBLISHED_SALT, salt_first, not salt_first)
                          .alias("pseudonym"))
    return run


def pseudonym_checks_q(spark, sf_dir):
    # Two stored tables, as the check of a finished run reads them.
    before = materialize(extracted(spark, sf_dir, INTEGRATED))
    after = materialize(pseudonymize(before, INTEGRATED, PUBLISHED_SALT))
    return pseudonym_checks(before, after, INTEGRATED)


def _leaks(table: str, id_col: str, text_col: str):
    def run(spark, sf_dir):
        t = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        return (t.where(F.col(text_col).rlike(DOTTED_QUAD_PATTERN))
                .select(F.col(id_col).alias("id"),
                        F.regexp_extract(text_col, DOTTED_QUAD_PATTERN, 0).alias("first_match"),
                        F.size(F.regexp_extract_all(text_col, F.lit(DOTTED_QUAD_PATTERN), F.lit(0)))
                        .cast("bigint").alias("matches")))
    return run


def distinct_endpoints(spark, sf_dir):
    return G.distinct_endpoints(packets(spark, sf_dir))


def value_ranges(spark, sf_dir):
    df, *_ = validate(extracted(spark, sf_dir, INTEGRATED), INTEGRATED)
    return G.value_ranges(df, ["src_port", "dst_port", "length", "event_ns"])


def completeness(spark, sf_dir):
    return G.completeness(packets(spark, sf_dir), ["dns_query", "http_host", "http_path", "user_agent"])


def _extraction_stats(prof: Profile):
    def run(spark, sf_dir):
        return G.extraction_stats(extract(raw_export(spark, sf_dir), prof).tagged)
    return run


def _written_export(spark: SparkSession, sf_dir: str, prof: Profile) -> DataFrame:
    """The export written as text, a folder per capture with a header in each file, and read back."""
    fields = RAW16_FIELDS if prof.ipv6 else RAW13_FIELDS
    raw = raw_export(spark, sf_dir)
    sep, pid = ("\t" if prof.ipv6 else ","), F.col("packet_id")
    cells = [F.coalesce(F.col(f"`{f}`"), F.lit("")) for f in fields]
    if not prof.ipv6:
        # Absent fields stay bare, present ones are quoted with their quotes doubled.
        cells = [F.when(c == "", c).otherwise(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
                 for c in cells]
    line = F.concat_ws(sep, *cells)
    if not prof.ipv6:  # some rows lack their last two fields, others have one more
        line = (F.when(pid % 67 == 0, F.concat_ws(sep, *cells[:-2]))
                .when(pid % 61 == 0, F.concat(line, F.lit(",extra"))).otherwise(line))
    # Names with a blank and a plus, which file systems escape in their own ways.
    capture = F.concat(F.lit("a b+"), F.regexp_extract("source_file", "([0-9]+)", 1))
    body = raw.select(capture.alias("capture"), F.lit(1).alias("place"), line.alias("line"))
    header = body.select("capture").distinct().select("capture", F.lit(0).alias("place"), F.lit(sep.join(fields)).alias("line"))
    folder = f"{_scratch(spark)}/exports/{uuid.uuid4().hex}"
    (body.unionByName(header).repartition("capture").sortWithinPartitions("capture", "place")
     .drop("place").write.partitionBy("capture").text(folder))
    read = read_export(spark, f"{folder}/*", prof, by_folder=True)
    return read.withColumn("source_file", F.regexp_replace("source_file", "^capture=", ""))


def _roundtrip(prof: Profile):
    """The written export extracted; rows per capture and outcome."""
    def run(spark, sf_dir):
        return G.outcome_counts(extract(_written_export(spark, sf_dir, prof), prof).tagged)
    return run


def export_rows_per_file(spark, sf_dir):
    """Rows and short rows of each file of the quoted export; no field is extracted for it."""
    read = _written_export(spark, sf_dir, MODULAR)
    return read.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"), F.count_if("short_row").alias("short_rows"))


def _scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/wiretable/{spark.sparkContext.applicationId}"


def _loads(prof: Profile):
    """The loaded table written twice (overwrite, then append), checked after both."""
    def run(spark, sf_dir):
        t = loaded_table(spark, sf_dir, prof)
        if not prof.length_required:  # rows without a length are loaded too
            t = t.withColumn("length", F.when(F.col("packet_id") % 7 != 0, F.col("length")))
        name = f"wiretable_load_{prof.name}_{uuid.uuid4().hex}"
        write_table(t, name, prof)
        write_table(t, name, prof, mode="append")
        checks = materialize(load_checks(spark.table(name), prof))
        spark.sql(f"DROP TABLE {name}")
        return checks
    return run


def replayed_load_checks(spark, sf_dir):
    """Two loads, of which the first is written again: nothing is doubled and every id stays."""
    t = loaded_table(spark, sf_dir, MODULAR)
    name = f"wiretable_replay_{uuid.uuid4().hex}"
    write_load(t, name, MODULAR, "a")
    write_load(t, name, MODULAR, "b")
    before = materialize(spark.table(name).select("id", "packet_id", "load_id"))
    write_load(t, name, MODULAR, "a")
    after = spark.table(name)
    kept = after.join(before, ["id", "packet_id", "load_id"], "left_semi").agg(F.count(F.lit(1)).alias("kept_ids"))
    checks = materialize(load_checks(after, MODULAR).withColumn("k", F.lit(1)).join(kept.withColumn("k", F.lit(1)), "k").drop("k"))
    spark.sql(f"DROP TABLE {name}")
    return checks


def clustered_lookups(spark, sf_dir):
    """The busiest source, port and flow, looked up in the table clustered along the Z-order key."""
    t = loaded_table(spark, sf_dir, MODULAR)
    name = f"wiretable_clustered_{uuid.uuid4().hex}"
    flow = ["src_ip_anon", "dst_ip_anon", "dst_port"]
    write_clustered(t, name, [*flow, "event_time"])
    held = spark.table(name)
    parts = []
    for lookup, keys in (("source", flow[:1]), ("port", flow[2:]), ("flow", flow)):
        busiest = (t.where(F.col("dst_port").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                   .orderBy(F.desc("n"), *keys).first())
        rows = held
        for k in keys:
            rows = rows.where(F.col(k) == (busiest[k] if busiest else None))
        parts.append(rows.agg(F.lit(lookup).alias("lookup"), F.count(F.lit(1)).alias("packets"), F.sum(F.col("length").cast("long")).alias("bytes"),
                              F.min("packet_id").alias("first_packet"), F.max("packet_id").alias("last_packet")))
    found = materialize(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    spark.sql(f"DROP TABLE {name}")
    return found


def service_share(spark, sf_dir):
    return Q.service_share(network_traffic(spark, sf_dir))


def large_packets(spark, sf_dir):
    t = Q.large_packets(network_traffic(spark, sf_dir))
    return t.select("packet_id", "src_ip_anonimizada", "dst_ip_anonimizada", "protocol", "dst_port", "length")


def stage_roundtrip(spark, sf_dir):
    """The cleaned rows written as a CSV stage and read with their schema."""
    rows = loaded_table(spark, sf_dir, MODULAR).select("packet_id", "src_ip_anon", "dst_port", "length", "dns_query")
    folder = f"{_scratch(spark)}/stages/{uuid.uuid4().hex}"
    write_stage(rows, folder, "csv")
    return read_stage(spark, folder, rows.schema, "csv")


SPELLINGS = [
    "MMM d, yyyy HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy HH:mm:ss",
    "d MMM yyyy HH:mm:ss", "MMMM d, yyyy H:mm:ss", "yyyy-M-d HH:mm", "yyyy-MM-dd",
]


def timestamp_spellings(spark, sf_dir):
    """Packet times in several spellings (zone signs added to some, and years beyond nanoseconds)."""
    ts = F.expr("timestampadd(MICROSECOND, t_us, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    kind = F.pmod(F.col("packet_id"), F.lit(len(SPELLINGS) + 1))
    text = F.lit("9999-12-31 00:00:00")
    for k, f in enumerate(SPELLINGS):
        zone = {1: " CEST", 2: "Z", 3: " UTC", 4: "+02:00"}.get(k, "")
        text = F.when(kind == k, F.concat(F.date_format(ts, f), F.lit(zone))).otherwise(text)
    df = bind(packets(spark, sf_dir), text=text)
    a, b = X.parse_time_integrated(F.col("text")), X.parse_time_modular(F.col("text"))
    return df.select("packet_id", X.time_ns(a, X.time_text_integrated(F.col("text"))).alias("ns_integrated"),
                     X.time_ns(b, X.time_text_modular(F.col("text"))).alias("ns_modular"), b.isNotNull().alias("valid_modular"))


def hash_distribution(spark, sf_dir):
    return hash_metrics(network_traffic(spark, sf_dir), INTEGRATED)


def distinct_ports_per_source(spark, sf_dir):
    """Distinct typed destination ports per source address."""
    pk = packets(spark, sf_dir).withColumn("dst_port_n", X.port_value(F.col("dst_port")))
    return G.distinct_per_group(pk, "src_ip", "dst_port_n") \
        .withColumnRenamed("distinct_dst_port_n", "distinct_dst_ports")


def extraction_top_protocols(spark, sf_dir):
    """Top 5 protocol labels of the rows kept by the modular extraction."""
    return G.value_distribution(extracted(spark, sf_dir, MODULAR), "protocol", top=5)


def value_ranges_modular(spark, sf_dir):
    """Ranges as the modular report shows them: time as *text*, ports typed."""
    df, *_ = validate(extracted(spark, sf_dir, MODULAR), MODULAR)
    return G.value_ranges(df, ["timestamp", "src_port", "dst_port"])


def missing_counts(spark, sf_dir):
    """NULL-or-empty count of every text column of the packet view."""
    return G.missing_counts(packets(spark, sf_dir), TEXT_COLUMNS)


def protocol_distribution(spark, sf_dir):
    return G.value_distribution(network_traffic(spark, sf_dir), "protocol")


def _q_modular(name):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = network_traffic_modular(spark, sf_dir)
        if name == "q2_top_destinations":
            return Q.q2_top_destinations(t, "dst_ip_anon")
        return Q.QUERIES[name](t)
    return run


def _counters(prof: Profile):
    def run(spark, sf_dir):
        return clean_counters(cleaned(spark, sf_dir, prof), prof)
    return run


def cleaned_rows_keep_flagged_modular(spark, sf_dir):
    """Modular cleaning where rows with an attack signal bypass flow thinning."""
    ex = extracted(spark, sf_dir, MODULAR)
    return _cleaned_output(clean(ex, MODULAR, keep_flagged=True).clean)


def _cleaned_rows(prof: Profile):
    def run(spark, sf_dir):
        return _cleaned_output(cleaned(spark, sf_dir, prof).clean)
    return run


QUERIES = {
    **{name: _q(name) for name in Q.QUERIES},
    "protocol_labels": protocol_labels,
    "normalize_integrated": _normalize(INTEGRATED),
    "normalize_modular": _normalize(MODULAR),
    "timestamp_parse": timestamp_parse,
    "relevance_rules": relevance_rules,
    "internal_split": internal_split,
    "reject_reasons_integrated": _rejects(INTEGRATED),
    "reject_reasons_modular": _rejects(MODULAR),
    "port_scanners": port_scanners_q,
    "signals_integrated": _signals(INTEGRATED),
    "signals_modular": _signals(MODULAR),
    "exact_dedup": exact_dedup,
    "first_per_tuple": first_per_tuple,
    "flow_thin_60s": _thin(60, True),
    "flow_thin_1s": _thin(1, False),
    "pseudonyms_salt_first": _pseudonyms(True),
    "pseudonyms_salt_last": _pseudonyms(False),
    "pseudonym_checks": pseudonym_checks_q,
    "ip_leak_scan": _leaks("documents", "doc_id", "text"),
    "ip_leak_scan_pages": _leaks("pages", "page_id", "html"),
    "ip_leak_scan_conversations": _leaks("conversations", "conv_id", "text"),
    "distinct_endpoints": distinct_endpoints,
    "value_ranges": value_ranges,
    "completeness": completeness,
    "extraction_stats": _extraction_stats(MODULAR),
    "extraction_stats_integrated": _extraction_stats(INTEGRATED),
    "export_roundtrip_integrated": _roundtrip(INTEGRATED),
    "export_roundtrip_modular": _roundtrip(MODULAR),
    "export_rows_per_file": export_rows_per_file,
    "load_checks_integrated": _loads(INTEGRATED),
    "load_checks_modular": _loads(MODULAR),
    "stage_roundtrip": stage_roundtrip,
    "timestamp_spellings": timestamp_spellings,
    "hash_distribution": hash_distribution,
    "protocol_distribution": protocol_distribution,
    "distinct_ports_per_source": distinct_ports_per_source,
    "extraction_top_protocols": extraction_top_protocols,
    "value_ranges_modular": value_ranges_modular,
    "missing_counts": missing_counts,
    **{f"{name}_modular": _q_modular(name) for name in Q.QUERIES},
    "clean_counters_integrated": _counters(INTEGRATED),
    "clean_counters_modular": _counters(MODULAR),
    "cleaned_rows_integrated": _cleaned_rows(INTEGRATED),
    "cleaned_rows_modular": _cleaned_rows(MODULAR),
    "cleaned_rows_keep_flagged_modular": cleaned_rows_keep_flagged_modular,
    "replayed_load_checks": replayed_load_checks,
    "clustered_lookups": clustered_lookups,
    "service_share": service_share,
    "large_packets": large_packets,
    **THREAT_QUERIES,
}
