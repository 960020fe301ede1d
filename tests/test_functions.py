"""Literal-row fixtures, one row per rule branch (FIXTURES.md §4)."""

import random

from pyspark.sql import functions as F

from wiretable.functions import fields as X
from wiretable.functions.addresses import is_internal, is_valid_ip, octets
from wiretable.operators.relevance import with_relevance


def _eval(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_address_validity(spark):
    cases = {
        "10.0.2.15": True, "010.0.2.15": False, "256.1.1.1": False, "1.2.3": False,
        "1.2.3.4,5.6.7.8": False, " 1.2.3.4 ": True, "::": True, "::1": True, "1::": True,
        "::ffff:1.2.3.4": True, "fe80::1%eth0": True, "fe80::1%": False,
        "1:2:3:4:5:6:7:8:9": False, "1::2::3": False, "2001:db8::1": True, "": False,
        "1:2:3:4:5:6:1.2.3.4": True, "999.1.2.3": False,
    }
    got = _eval(spark, list(cases), is_valid_ip)
    assert dict(zip(cases, got)) == cases
    assert _eval(spark, [None], is_valid_ip) == [False]


def test_internal_addresses(spark):
    cases = {
        "10.1.2.3": True, "172.16.0.1": True, "172.32.0.1": False, "192.168.1.1": True,
        "127.0.0.1": True, "169.254.1.1": True, "8.8.8.8": False, "224.0.0.1": False,
        "255.255.255.255": False, "2001:db8::1": True, "a.b.c.d": True, "": True,
        "999.1.2.3": False, "010.1.2.3": True,
    }
    got = _eval(spark, list(cases), lambda c: is_internal(octets(c)))
    assert dict(zip(cases, got)) == cases
    assert _eval(spark, [None], lambda c: is_internal(octets(c))) == [True]


def test_ports(spark):
    cases = {"443": True, "443.0": True, "0": True, "65535": True, "65536": False, "-1": False,
             "-0.5": True, "abc": False, "inf": False, "53,53": False, "": True}
    got = _eval(spark, list(cases), X.port_is_valid)
    assert dict(zip(cases, got)) == cases
    assert _eval(spark, [None], X.port_is_valid) == [True]
    assert _eval(spark, ["443.0", "-0.5", "70000", "x", None], X.port_value) == [443, 0, None, None, None]


def test_timestamps(spark):
    rows = ["May 17, 2023 10:44:38.201312000 CEST", "May 17, 2023 10:44:38.201312 CET",
            "May 17, 2023 10:44:38 UTC", '"May 17, 2023 10:44:38.5"', "May  7, 2023 10:44:38",
            "2023-05-17 10:44:38", "17/05/2023 10:44:38", "05/17/2023 10:44:38", "junk", None]
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    out = df.select(X.time_ns(X.parse_time_integrated(F.col("v")), X.time_text_integrated(F.col("v")))
                    .alias("ns")).collect()
    ns = [r.ns for r in out]
    base = 1684320278 * 10**9
    assert ns[0] == base + 201312000
    assert ns[1] == base + 201312000
    assert ns[2] == base
    assert ns[3] == base + 500000000
    assert ns[4] == base - 10 * 86400 * 10**9
    assert ns[5] == base and ns[6] == base and ns[7] == base
    assert ns[8] is None and ns[9] is None


def test_formats_chosen_by_signs_parse_alike(spark):
    rng = random.Random(6)
    dates = ["Mar 5, 2024", "March 5, 2024", "5 Oct 2024", "12 august 2024", "2024-3-5", "2024-03-15", "3/25/2024", "25/3/2024", "4/5/2024",
             "Mar 5 2024", "T", "", "-2024-1-2", "+12024-1-2", "2024/3/5"]
    clocks = ["", " 10:02", " 1:2:3", "T10:02:03", "t10:02:03.5", " 10:02:03.123456789", " 10:02:03.123456", ", 10:02", " 25:00", " 10"]
    texts = {d + c for d in dates for c in clocks}
    for text in sorted(texts):
        at = rng.randrange(len(text) + 1)
        texts |= {text[:at] + rng.choice("/,:-T ax1") + text[at:], text[:at] + text[at + 1:]}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "v string")
    for formats in (X.FLEX_FORMATS, X.MODULAR_FORMATS):
        both = df.select("v", X.parse_formats(F.col("v"), formats).alias("every"), X.parse_by_signs(F.col("v"), formats).alias("chosen"))
        assert both.where(~F.col("every").eqNullSafe(F.col("chosen"))).collect() == []
        assert both.where("every is not null").count() > 20


def test_timestamp_spellings_and_odd_years(spark):
    """What the generic parser accepts is accepted, and no year aborts a job."""
    base = 1684317843 * 10**9      # 2023-05-17 10:04:03
    june = 1687082400 * 10**9      # 2023-06-18 10:00:00
    rows = {
        "17/5/2023 10:04:03": base, "2023-5-17 10:04:03": base, "May 17, 2023 10:4:3": base,
        "June 18, 2023 10:00:00": june, "17 May 2023 10:04:03": base, "2023-06-18 10:00": june,
        "2023-05-17T10:04:03Z": base, "2023-05-17 10:04:03+02:00": base, "2023-05-17T10:04:03 +0200": base,
        "5/7/2023 9:05:03": 1683450303 * 10**9,      # ambiguous: month first
        "9999-12-31": None, "1600-01-01": None, "0001-01-01": None,
    }
    df = spark.createDataFrame([(t,) for t in rows], "timestamp string")
    for text, parse in ((X.time_text_integrated, X.parse_time_integrated), (X.time_text_modular, X.parse_time_modular)):
        got = df.select("timestamp", X.time_ns(parse(F.col("timestamp")), text(F.col("timestamp"))).alias("ns")).collect()
        assert {r.timestamp: r.ns for r in got} == rows
    full = df.select("timestamp", F.lit("10.0.0.1").alias("src_ip"), F.lit("10.0.0.2").alias("dst_ip"), F.lit("TCP").alias("protocol"),
                     F.lit("1").alias("src_port"), F.lit("2").alias("dst_port"), F.lit("60").alias("length"))
    from wiretable.operators.quality import with_reject_reason
    bad = {p: {r.timestamp for r in with_reject_reason(full, p).where("reject_reason is not null").select("timestamp").collect()}
           for p in ("integrated", "modular")}
    assert bad == {"integrated": {t for t, ns in rows.items() if ns is None}, "modular": set()}


def test_protocol_labels(spark):
    nums = ["1", "2", "6", "17", "41", "47", "50", "51", "58", "89", "132", "200", "1,17"]
    a = _eval(spark, nums, X.protocol_label_integrated)
    b = _eval(spark, nums, X.protocol_label_modular)
    assert a == ["ICMP", "OTHER", "TCP", "UDP", "OTHER", "OTHER", "OTHER", "OTHER", "ICMPv6",
                 "OTHER", "OTHER", "OTHER", "OTHER"]
    assert b == ["ICMP", "IGMP", "TCP", "UDP", "IPv6", "GRE", "ESP", "AH", "ICMPv6", "OSPF",
                 "SCTP", "PROTO-200", "PROTO-1,17"]
    labels = ["tcp", " TCP ", "IPv6", "ICMPv6", "OTHER", "GRE"]
    assert _eval(spark, labels, X.protocol_whitelisted_modular) == [True, True, False, False, False, False]
    assert _eval(spark, labels, X.protocol_whitelisted_integrated) == [False, False, False, True, True, False]


def test_relevance_outcomes(spark):
    cols = "src_ip string, dst_ip string, src_port string, dst_port string, http_host string, " \
           "http_path string, user_agent string, dns_query string"
    rows = [
        (None, "8.8.8.8", "1", "2", None, None, None, None, 1),
        ("10.0.0.1", "10.0.0.2", "53", "1", None, None, None, None, 3),
        ("10.0.0.1", "10.0.0.2", "5353", "443", None, None, None, None, 4),   # web beats noise
        ("10.0.0.1", "8.8.8.8", "5353", "22", None, None, None, None, 5),     # noise beats important
        ("10.0.0.1", "10.0.0.2", "22", "1", None, None, None, None, 6),
        ("10.0.0.1", "8.8.8.8", "1000", "2000", None, None, None, None, 7),
        ("10.0.0.1", "10.0.0.2", "1000", "2000", "h", None, None, None, 8),
        ("10.0.0.1", "10.0.0.2", "1000", "2000", None, None, None, None, 9),
        ("10.0.0.1", "10.0.0.2", "53.0", "53", None, None, None, None, 9),    # non-integer -> 0, 0
        ("2001:db8::1", "2001:db8::2", "1000", "2000", None, None, None, None, 9),
        ("10.0.0.1", "224.0.0.1", "1000", "2000", None, None, None, None, 7),  # multicast external
    ]
    df = spark.createDataFrame([r[:-1] for r in rows], cols)
    got = [r.relevance_rule for r in with_relevance(df).collect()]
    assert got == [r[-1] for r in rows]


def test_pseudonym_golden_vectors(spark):
    salt = "cybersec_dataset_2025"
    df = spark.createDataFrame([("10.0.2.15",), ("192.168.1.1",), (None,), ("",)], "ip string")
    first = [r[0] for r in df.select(X.pseudonym(F.col("ip"), salt, True, False)).collect()]
    last = [r[0] for r in df.select(X.pseudonym(F.col("ip"), salt, False, True)).collect()]
    assert first[0] == "7a62ce71a155f743"
    assert last[:2] == ["4e5c743ef893bc85", "80537bff259cc51b"]
    assert first[2:] == [None, None]
    assert last[2:] == ["", ""]


def _signals_of(spark, rows, profile):
    from wiretable.operators.signals import with_signals
    df = spark.createDataFrame(rows, "src_ip string, src_port_n int, dst_port_n int, length_n int, "
                                     "dns_query string, http_path string")
    return [r.signals for r in with_signals(df, profile).orderBy("src_ip", "dst_port_n").collect()]


def test_signals_integrated(spark):
    from wiretable.functions import constants as K
    rows = [("scan11", 1000, p, 60, None, None) for p in range(2000, 2011)]      # 11 distinct ports
    rows += [("scan10", 1000, p, 60, None, None) for p in range(3000, 3010)]     # exactly 10
    rows += [("scan10", 1000, None, 60, None, None)]                             # NULL port not counted
    rows += [("quiet", 1000, p, 60, None, None) for p in K.SENSITIVE_PORTS]
    rows += [("quiet", 1000, 8443, 60, "x.example", None)]
    got = _signals_of(spark, rows, "integrated")
    by_src = {}
    for (src, *_), sig in zip(sorted(rows, key=lambda r: (r[0], -1 if r[2] is None else r[2])), got):
        by_src.setdefault(src, []).append(sig)
    assert all("port_scan" in s for s in by_src["scan11"])
    assert not any("port_scan" in s for s in by_src["scan10"])
    quiet = by_src["quiet"]
    assert sum("sensitive_port" in s for s in quiet) == len(K.SENSITIVE_PORTS)
    assert sum("dns_query" in s for s in quiet) == 1


def test_signals_modular(spark):
    from wiretable.functions import constants as K
    rows = [(f"p{p}", 1000, p, 60, None, None) for p in K.SUSPICIOUS_PORTS]
    rows += [("h1", 1000, 49152, 60, None, None), ("h2", 1000, 49153, 60, None, None),
             ("h3", None, 49153, 60, None, None),                                 # one port NULL
             ("l39", 1000, 2000, 39, None, None), ("l40", 1000, 2000, 40, None, None),
             ("l9000", 1000, 2000, 9000, None, None), ("l9001", 1000, 2000, 9001, None, None)]
    rows += [(f"d{i}", 1000, 2000, 60, t.upper() + ".EXAMPLE", None)
             for i, t in enumerate(K.SUSPICIOUS_DNS_TOKENS)]
    rows += [(f"u{i}", 1000, 2000, 60, None, "/X/" + t.upper()) for i, t in enumerate(K.SUSPICIOUS_PATH_TOKENS)]
    rows += [("udot", 1000, 2000, 60, None, "/xasp")]                          # '.asp' needs the dot
    from wiretable.operators.signals import with_signals
    df = spark.createDataFrame(rows, "src_ip string, src_port_n int, dst_port_n int, length_n int, "
                                     "dns_query string, http_path string")
    sig = {r.src_ip: r.signals for r in with_signals(df, "modular").collect()}
    assert all(sig[f"p{p}"] == ["suspicious_port"] for p in K.SUSPICIOUS_PORTS)
    assert sig["h1"] == [] and sig["h2"] == ["high_port"] and sig["h3"] == []
    assert sig["l39"] == ["unusual_packet_size"] and sig["l40"] == []
    assert sig["l9000"] == [] and sig["l9001"] == ["unusual_packet_size"]
    assert all(sig[f"d{i}"] == ["suspicious_dns"] for i in range(len(K.SUSPICIOUS_DNS_TOKENS)))
    assert all(sig[f"u{i}"] == ["suspicious_http_path"] for i in range(len(K.SUSPICIOUS_PATH_TOKENS)))
    assert sig["udot"] == []
