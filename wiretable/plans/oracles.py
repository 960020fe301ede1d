"""Independent DuckDB SQL for every registered query (the correctness gate).

Each statement inlines the packet view as a CTE (the gate registers only the
base tables) and restates the rule in plain SQL.  The greedy flow thinning is
written as a recursive CTE: one step per kept packet, which is fine for a
check at small scale and is exactly the sequential definition.
"""

from __future__ import annotations

from ..functions import constants as K
from ..sources.packets import packet_view_sql
from .registry import PUBLISHED_SALT

PK = "pk AS (" + packet_view_sql("duckdb") + ")"


def _ints(values) -> str:
    return ", ".join(str(v) for v in values)


def _strs(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def _case_map(expr: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {default} END)"


def label_a(c: str) -> str:
    return _case_map(c, K.PROTOCOL_LABELS_INTEGRATED, f"'{K.PROTOCOL_OTHER_INTEGRATED}'")


def label_b(c: str) -> str:
    return _case_map(c, K.PROTOCOL_LABELS_MODULAR, f"'{K.PROTOCOL_PREFIX_MODULAR}' || coalesce({c}, '')")


def missing(c: str) -> str:
    return f"({c} IS NULL OR {c} = '')"


# A dotted quad anywhere in a text.
QUAD = r"\b[0-9]{1,3}([.][0-9]{1,3}){3}\b"


def _quad_ok(t: str) -> str:
    """Four parts, each a number up to 255 without sign, blank or leading zero."""
    return (f"(len(string_split({t}, '.')) = 4 AND len(list_filter(string_split({t}, '.'), "
            "lambda p: regexp_matches(p, '^[0-9]{1,3}$') AND TRY_CAST(p AS INTEGER) <= 255 "
            "AND (p = '0' OR p[1] <> '0'))) = 4)")


def valid_ip(c: str) -> str:
    """Address test by splitting and counting groups (the engine uses one generated pattern)."""
    t = f"trim({c}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    scope = f"(instr({t}, '%') = 0 OR (len(string_split({t}, '%')) = 2 AND string_split({t}, '%')[2] <> ''))"
    head = f"string_split({t}, '%')[1]"
    last = f"string_split({head}, ':')[-1]"
    # An embedded quad counts as two groups.
    tail = f"(CASE WHEN contains({last}, '.') THEN CASE WHEN {_quad_ok(last)} THEN 1 ELSE -99 END ELSE 0 END)"
    groups = f"list_filter(string_split({head}, ':'), lambda g: g <> '')"
    plain = (f"len(list_filter({groups}, lambda g: NOT contains(g, '.') AND NOT regexp_matches(g, '^[0-9A-Fa-f]{{1,4}}$'))) = 0")
    gaps = f"(len({head}) - len(replace({head}, '::', '')))"
    n = f"(len({groups}) + {tail})"
    edges = (f"(starts_with({head}, '::') OR NOT starts_with({head}, ':')) AND "
             f"(ends_with({head}, '::') OR NOT ends_with({head}, ':')) AND NOT contains({head}, ':::')")
    v6 = (f"(contains({t}, ':') AND {scope} AND {edges} AND {plain} AND len(list_filter({groups}, lambda g: contains(g, '.'))) <= 1 "
          f"AND (({gaps} = 0 AND {n} = 8) OR ({gaps} = 2 AND {n} BETWEEN 0 AND 7)))")
    return f"coalesce({_quad_ok(t)} OR {v6}, false)"


def port_ok(c: str) -> str:
    d = f"TRY_CAST({c} AS DOUBLE)"
    return f"({missing(c)} OR coalesce({d} > -1 AND {d} < 65536, false))"


def port_val(c: str) -> str:
    d = f"TRY_CAST({c} AS DOUBLE)"
    return f"(CASE WHEN {d} > -1 AND {d} < 65536 THEN CAST(trunc({d}) AS INTEGER) END)"


def len_val(c: str) -> str:
    return f"CAST(trunc(TRY_CAST(trim({c}) AS DOUBLE)) AS INTEGER)"


def text_a(c: str) -> str:
    return ("regexp_replace(regexp_replace(" + c + r""", '^"+|"+$', '', 'g'), '"""
            + K.ZONE_SUFFIX_PATTERN + "', '')")


def text_b(c: str) -> str:
    s = f"trim({c})"
    whens = " ".join(f"WHEN contains({s}, '{z}') THEN replace({s}, '{z}', '')" for z in K.MODULAR_ZONE_SUFFIXES)
    return f"(CASE {whens} ELSE {s} END)"


TIME_FORMATS = "['%b %d, %Y %H:%M:%S.%n', '%b %d, %Y %H:%M:%S']"


def ns_a(c: str) -> str:
    return f"epoch_ns(try_strptime({text_a(c)}, {TIME_FORMATS}))"


def valid_time_b(c: str) -> str:
    return f"(try_strptime({text_b(c)}, {TIME_FORMATS}) IS NOT NULL)"


def ns_b(c: str) -> str:
    return f"epoch_ns(try_strptime({text_b(c)}, {TIME_FORMATS}))"


def int_text(c: str) -> str:
    return (r"(CASE WHEN regexp_matches(" + c + r", '^\s*[+-]?[0-9]+\s*$') THEN "
            f"coalesce(TRY_CAST(trim({c}) AS BIGINT), -1) END)")


def internal(c: str) -> str:
    p1 = f"TRY_CAST(trim(string_split({c}, '.')[1]) AS INTEGER)"
    p2 = f"TRY_CAST(trim(string_split({c}, '.')[2]) AS INTEGER)"
    return (f"(CASE WHEN {missing(c)} THEN true WHEN len(string_split({c}, '.')) <> 4 THEN true "
            f"WHEN {p1} IS NULL OR {p2} IS NULL THEN true "
            f"ELSE ({p1} = 10 OR ({p1} = 172 AND {p2} BETWEEN 16 AND 31) OR ({p1} = 192 AND {p2} = 168) "
            f"OR {p1} = 127 OR ({p1} = 169 AND {p2} = 254)) END)")


TEXT = ["frame_time", "src_ip", "dst_ip", "ip_proto", "src_port", "dst_port", "length",
        "dns_query", "http_host", "http_path", "user_agent"]


def _x(label) -> str:
    """Extracted contract over the view, '' as missing."""
    cols = ", ".join(f"nullif({c}, '') AS {c}" for c in TEXT if c != "frame_time")
    return (f"x0 AS (SELECT packet_id, nullif(frame_time, '') AS timestamp, {cols} FROM pk), "
            f"x AS (SELECT * EXCLUDE (ip_proto), {label('ip_proto')} AS protocol FROM x0)")


def _relevance_ctes(src: str) -> str:
    """r: rows of ``src`` with relevance_rule."""
    return (
        f"r0 AS (SELECT *, CASE WHEN {missing('src_port')} THEN 0 ELSE {int_text('src_port')} END AS _rs, "
        f"CASE WHEN {missing('dst_port')} THEN 0 ELSE {int_text('dst_port')} END AS _rd FROM {src}), "
        "r1 AS (SELECT *, CASE WHEN _rs IS NOT NULL AND _rd IS NOT NULL THEN _rs ELSE 0 END AS _s, "
        "CASE WHEN _rs IS NOT NULL AND _rd IS NOT NULL THEN _rd ELSE 0 END AS _d FROM r0), "
        "r AS (SELECT * EXCLUDE (_rs, _rd, _s, _d), CASE "
        f"WHEN {missing('src_ip')} OR {missing('dst_ip')} THEN 1 "
        f"WHEN _s = {K.DNS_PORT} OR _d = {K.DNS_PORT} THEN 3 "
        f"WHEN _s IN ({_ints(K.WEB_PORTS)}) OR _d IN ({_ints(K.WEB_PORTS)}) THEN 4 "
        f"WHEN _s IN ({_ints(K.NOISE_PORTS)}) OR _d IN ({_ints(K.NOISE_PORTS)}) THEN 5 "
        f"WHEN _s IN ({_ints(K.IMPORTANT_PORTS)}) OR _d IN ({_ints(K.IMPORTANT_PORTS)}) THEN 6 "
        f"WHEN NOT ({internal('src_ip')} AND {internal('dst_ip')}) THEN 7 "
        f"WHEN NOT {missing('http_host')} OR NOT {missing('http_path')} OR NOT {missing('user_agent')} "
        f"OR NOT {missing('dns_query')} THEN 8 ELSE 9 END AS relevance_rule FROM r1)")


def _reason(profile: str) -> str:
    if profile == "integrated":
        ts_bad = f"{ns_a('timestamp')} IS NULL"
        proto_ok = f"coalesce(protocol IN ({_strs(K.PROTOCOL_WHITELIST_INTEGRATED)}), false)"
        pok = port_ok
    else:
        ts_bad = f"NOT {valid_time_b('timestamp')}"
        proto_ok = f"coalesce(upper(trim(protocol)) IN ({_strs(K.PROTOCOL_WHITELIST_MODULAR)}), false)"
        pok = lambda c: f"({port_ok(c)} OR {c} = 'nan')"
    req = " OR ".join(missing(c) for c in ["timestamp", "src_ip", "dst_ip", "protocol"])
    return (f"CASE WHEN {req} THEN 'missing_required' "
            f"WHEN NOT ({valid_ip('src_ip')} AND {valid_ip('dst_ip')}) THEN 'invalid_ip' "
            f"WHEN NOT ({pok('src_port')} AND {pok('dst_port')}) THEN 'invalid_port' "
            f"WHEN {ts_bad} THEN 'invalid_timestamp' "
            f"WHEN NOT {proto_ok} THEN 'invalid_protocol' END")


def _source(profile: str) -> str:
    """CTEs ending in ``src`` = extracted rows of the profile's export."""
    head = _raw_export() + ", " + _normalized(profile) + ", "
    if profile == "integrated":
        return head + (f"src AS (SELECT * FROM nx WHERE NOT {missing('src_ip')} AND NOT {missing('dst_ip')} "
                       f"AND NOT {missing('timestamp')})")
    return (head + _relevance_ctes("nx")
            + ", src AS (SELECT * EXCLUDE (relevance_rule) FROM r WHERE relevance_rule IN (3, 4, 6, 7, 8))")


def _ok(profile: str) -> str:
    ns = ns_a("timestamp") if profile == "integrated" else ns_b("timestamp")
    return (f"v AS (SELECT *, {_reason(profile)} AS reason FROM src), "
            f"ok AS (SELECT packet_id, timestamp, src_ip, dst_ip, protocol, "
            f"{port_val('src_port')} AS src_port, {port_val('dst_port')} AS dst_port, "
            f"{len_val('length')} AS length, dns_query, http_host, http_path, user_agent, "
            f"{ns} AS event_ns FROM v WHERE reason IS NULL)")


def _tokens(tokens) -> str:
    return "|".join(t.replace(".", "[.]") for t in tokens)


def _signals(profile: str) -> str:
    if profile == "integrated":
        return (
            "scan AS (SELECT src_ip FROM ok WHERE dst_port IS NOT NULL GROUP BY src_ip "
            f"HAVING count(DISTINCT dst_port) > {K.PORT_SCAN_MIN_DISTINCT}), "
            "sig AS (SELECT ok.*, concat_ws(',', "
            "CASE WHEN ok.src_ip IN (SELECT src_ip FROM scan) THEN 'port_scan' END, "
            f"CASE WHEN dst_port IN ({_ints(K.SENSITIVE_PORTS)}) THEN 'sensitive_port' END, "
            "CASE WHEN dns_query IS NOT NULL THEN 'dns_query' END) AS signals FROM ok)")
    both = "(src_port IS NOT NULL AND dst_port IS NOT NULL)"
    return (
        "sig AS (SELECT ok.*, concat_ws(',', "
        f"CASE WHEN {both} AND (src_port IN ({_ints(K.SUSPICIOUS_PORTS)}) OR dst_port IN "
        f"({_ints(K.SUSPICIOUS_PORTS)})) THEN 'suspicious_port' END, "
        f"CASE WHEN {both} AND (src_port > {K.HIGH_PORT_ABOVE} OR dst_port > {K.HIGH_PORT_ABOVE}) "
        "THEN 'high_port' END, "
        f"CASE WHEN length < {K.SMALL_PACKET_BELOW} OR length > {K.LARGE_PACKET_ABOVE} "
        "THEN 'unusual_packet_size' END, "
        f"CASE WHEN regexp_matches(lower(dns_query), '{_tokens(K.SUSPICIOUS_DNS_TOKENS)}') "
        "THEN 'suspicious_dns' END, "
        f"CASE WHEN regexp_matches(lower(http_path), '{_tokens(K.SUSPICIOUS_PATH_TOKENS)}') "
        "THEN 'suspicious_http_path' END) AS signals FROM ok)")


def _greedy(nodes_src: str, key: list[str], t: str, w: int, out: str) -> str:
    """Recursive-CTE greedy thinning; ``out`` = kept representative packet ids."""
    k = ", ".join(key)
    return (
        f"n AS (SELECT {k}, {t} AS t, min(packet_id) AS rep FROM {nodes_src} WHERE {t} IS NOT NULL "
        f"GROUP BY ALL), "
        f"g AS (SELECT *, dense_rank() OVER (ORDER BY {k}) AS fid FROM n), "
        "chain(fid, t) AS (SELECT fid, min(t) FROM g GROUP BY fid UNION ALL "
        f"SELECT c.fid, (SELECT min(g2.t) FROM g g2 WHERE g2.fid = c.fid AND g2.t >= c.t + {w}) "
        "FROM chain c WHERE c.t IS NOT NULL), "
        f"{out} AS (SELECT g.rep AS packet_id FROM chain c JOIN g ON g.fid = c.fid AND g.t = c.t)")


def _clean(profile: str, keep_flagged: bool = False) -> str:
    if profile == "integrated":
        dedup = ["event_ns", "src_ip", "dst_ip", "protocol", "src_port", "dst_port", "length",
                 "dns_query", "http_host", "http_path", "user_agent"]
        key = ["src_ip", "dst_ip", "protocol", "src_port", "dst_port"]
        w = K.FLOW_WINDOW_INTEGRATED_S * 1_000_000_000
    else:
        dedup = ["timestamp", "event_ns", "src_ip", "dst_ip", "protocol", "src_port", "dst_port",
                 "length", "dns_query", "http_host", "http_path", "user_agent"]
        key = ["src_ip", "dst_ip", "src_port", "dst_port"]
        w = K.FLOW_WINDOW_MODULAR_S * 1_000_000_000
    d = ", ".join(dedup)
    head = (f"{_source(profile)}, {_ok(profile)}, {_signals(profile)}, "
            f"d1 AS (SELECT min(packet_id) AS packet_id, {d}, signals FROM sig GROUP BY {d}, signals), ")
    if not keep_flagged:
        return head + (f"{_greedy('d1', key, 'event_ns', w, 'kept')}, "
                       "cl AS (SELECT * FROM d1 WHERE packet_id IN (SELECT packet_id FROM kept))")
    return head + ("d1n AS (SELECT * FROM d1 WHERE signals = ''), "
                   f"{_greedy('d1n', key, 'event_ns', w, 'kept')}, "
                   "cl AS (SELECT * FROM d1n WHERE packet_id IN (SELECT packet_id FROM kept) "
                   "UNION ALL SELECT * FROM d1 WHERE signals <> '')")


OUT_COLS = ("packet_id, event_ns, src_ip, dst_ip, protocol, src_port, dst_port, length, dns_query, "
            "http_host, http_path, user_agent, signals, signals <> '' AS is_attack_pattern")


def _hash(c: str, salt_first: bool) -> str:
    material = f"'{PUBLISHED_SALT}' || {c}" if salt_first else f"{c} || '{PUBLISHED_SALT}'"
    return f"substr(sha256({material}), 1, 16)"


def _nt() -> str:
    """network_traffic of the integrated profile."""
    return (_clean("integrated") + ", nt AS (SELECT * EXCLUDE (src_ip, dst_ip), "
            f"CASE WHEN {missing('src_ip')} THEN '' ELSE {_hash('src_ip', False)} END AS src_ip_anonimizada, "
            f"CASE WHEN {missing('dst_ip')} THEN '' ELSE {_hash('dst_ip', False)} END AS dst_ip_anonimizada "
            "FROM cl)")


def _nt_modular() -> str:
    """network_traffic of the modular profile (salt first, NULL for missing)."""
    return (_clean("modular") + ", nt AS (SELECT * EXCLUDE (src_ip, dst_ip), "
            f"CASE WHEN {missing('src_ip')} THEN NULL ELSE {_hash('src_ip', True)} END AS src_ip_anon, "
            f"CASE WHEN {missing('dst_ip')} THEN NULL ELSE {_hash('dst_ip', True)} END AS dst_ip_anon "
            "FROM cl)")


def _clustered_lookups() -> str:
    flow = ["src_ip_anon", "dst_ip_anon", "dst_port"]
    parts = []
    for lookup, keys in (("source", flow[:1]), ("port", flow[2:]), ("flow", flow)):
        own = ", ".join(keys)
        busiest = (f"(SELECT {own} FROM nt WHERE dst_port IS NOT NULL GROUP BY ALL "
                   f"ORDER BY count(*) DESC, {own} LIMIT 1)")
        parts.append(f"SELECT '{lookup}' AS lookup, count(*) AS packets, CAST(sum(length) AS BIGINT) AS bytes, min(packet_id) AS first_packet, "
                     f"max(packet_id) AS last_packet FROM nt JOIN {busiest} USING ({own})")
    return _with(_nt_modular(), " UNION ALL ".join(parts), True)


def _service_share(nt: str) -> str:
    svc = " ".join(f"WHEN dst_port = {p} THEN '{s}'" for p, s in K.SERVICE_LABELS.items())
    return _with(nt, "SELECT service_type, count(*) AS count, CAST((count(*) * 20000 + sum(count(*)) OVER ()) // (sum(count(*)) OVER () * 2) "
                     f"AS BIGINT) / 100 AS percentage FROM (SELECT CASE {svc} ELSE '{K.SERVICE_OTHER}' END AS service_type FROM nt) "
                     "GROUP BY service_type", True)


def _report_queries(nt: str, dst: str, suffix: str) -> dict[str, str]:
    svc = " ".join(f"WHEN dst_port = {p} THEN '{s}'" for p, s in K.SERVICE_LABELS.items())
    return {
        f"q1_total{suffix}": _with(nt, "SELECT count(*) AS total_records FROM nt", True),
        f"q2_top_destinations{suffix}": _with(nt, f"SELECT {dst}, count(*) AS count FROM nt GROUP BY 1 "
                                                  f"ORDER BY count DESC, {dst} NULLS FIRST LIMIT 10", True),
        f"q3_top_domains{suffix}": _with(nt, "SELECT dns_query, count(*) AS count FROM nt WHERE dns_query "
                                             "IS NOT NULL AND dns_query <> '' GROUP BY 1 "
                                             "ORDER BY count DESC, dns_query LIMIT 10", True),
        f"q4_top_ports{suffix}": _with(nt, f"SELECT dst_port, count(*) AS count, CASE {svc} ELSE "
                                           f"'{K.SERVICE_OTHER}' END AS service_type FROM nt WHERE dst_port "
                                           "IS NOT NULL GROUP BY dst_port ORDER BY count DESC, dst_port "
                                           "LIMIT 10", True),
        f"q5_length_stats{suffix}": _with(nt, "SELECT CAST(sum(length) AS BIGINT) / count(length) AS avg_length, "
                                              "max(length) AS max_length, min(length) AS min_length, "
                                              "CAST(sum(length) AS BIGINT) // count(length) AS avg_length_int "
                                              "FROM nt WHERE length IS NOT NULL", True),
        f"q6_protocol_share{suffix}": _with(nt, "SELECT protocol, count(*) AS count, "
                                                "(count(*) * 20000 + (SELECT count(*) FROM nt)) // "
                                                "((SELECT count(*) FROM nt) * 2) / 100 AS percentage FROM nt "
                                                "WHERE protocol IS NOT NULL GROUP BY protocol "
                                                "ORDER BY count DESC, protocol", True),
    }


def _counters(profile: str) -> str:
    body = _clean(profile) + ", " + (
        "m AS (SELECT 'initial' AS counter, count(*) AS v FROM src "
        "UNION ALL SELECT reason, count(*) FROM v WHERE reason IS NOT NULL GROUP BY reason "
        "UNION ALL SELECT 'attack_signals_seen', count(*) FILTER (WHERE signals <> '') FROM sig "
        "UNION ALL SELECT 'validated', count(*) FROM sig "
        "UNION ALL SELECT 'after_exact', count(*) FROM d1 "
        "UNION ALL SELECT 'final', count(*) FROM cl), "
        "w AS (SELECT max(v) FILTER (WHERE counter = 'initial') AS i, "
        "max(v) FILTER (WHERE counter = 'validated') AS va, max(v) FILTER (WHERE counter = 'after_exact') AS ae, "
        "max(v) FILTER (WHERE counter = 'final') AS f FROM m)")
    return _with(body, "SELECT counter, CAST(v AS DOUBLE) AS value FROM m "
                       "UNION ALL SELECT 'exact_duplicates', CAST(va - ae AS DOUBLE) FROM w "
                       "UNION ALL SELECT 'flow_duplicates', CAST(ae - f AS DOUBLE) FROM w "
                       "UNION ALL SELECT 'retention_pct', CASE WHEN i > 0 THEN "
                       "((f * 20000 + i) // (i * 2)) / 100 END FROM w", True)


def _pseudonym_checks() -> str:
    hs = _hash("src_ip", False)
    hd = _hash("dst_ip", False)
    quad = QUAD
    analytic = ["timestamp", "protocol", "src_port", "dst_port", "length", "dns_query", "http_host",
                "http_path", "user_agent"]
    body = (_source("integrated") + ", x AS (SELECT * FROM src), b AS (SELECT * FROM x), "
            f"a AS (SELECT * EXCLUDE (src_ip, dst_ip), CASE WHEN {missing('src_ip')} THEN '' ELSE {hs} END AS sa, "
            f"CASE WHEN {missing('dst_ip')} THEN '' ELSE {hd} END AS da FROM x), "
            "j AS (SELECT b.src_ip, b.dst_ip, a.sa, a.da FROM b JOIN a USING (packet_id)), "
            "g AS (SELECT * FROM (VALUES ('10.0.2.15'), ('192.168.1.1'), ('93.184.216.34')) t(ip)), "
            "m AS (SELECT "
            "(SELECT count(*) FROM b) AS b_rows, (SELECT count(*) FROM a) AS a_rows, "
            "(SELECT count(DISTINCT src_ip) FROM b) AS b_src, (SELECT count(DISTINCT nullif(sa, '')) FROM a) AS a_src, "
            "(SELECT count(DISTINCT dst_ip) FROM b) AS b_dst, (SELECT count(DISTINCT nullif(da, '')) FROM a) AS a_dst, "
            "(SELECT count(nullif(src_ip, '')) FROM b) AS b_src_nn, (SELECT count(nullif(sa, '')) FROM a) AS a_src_nn, "
            "(SELECT count(nullif(dst_ip, '')) FROM b) AS b_dst_nn, (SELECT count(nullif(da, '')) FROM a) AS a_dst_nn, "
            + ", ".join(f"(SELECT count({c}) FROM b) AS b_nn_{c}, (SELECT count({c}) FROM a) AS a_nn_{c}"
                        for c in analytic) + ", "
            f"(SELECT count(*) FILTER (WHERE NOT coalesce(regexp_matches(sa, '{K.HASH_FORMAT_PATTERN}'), false) "
            "AND NOT (sa IS NULL OR sa = '')) FROM a) AS bad_src, "
            f"(SELECT count(*) FILTER (WHERE NOT coalesce(regexp_matches(da, '{K.HASH_FORMAT_PATTERN}'), false) "
            "AND NOT (da IS NULL OR da = '')) FROM a) AS bad_dst, "
            f"(SELECT count(*) FILTER (WHERE coalesce(regexp_matches(sa, '{quad}'), false) "
            f"OR coalesce(regexp_matches(da, '{quad}'), false)) FROM a) AS leaks, "
            "(SELECT count(*) FILTER (WHERE n <> 1) FROM (SELECT count(DISTINCT (sa, da)) AS n FROM j "
            "GROUP BY src_ip, dst_ip)) AS broken, "
            "(SELECT count(*) FILTER (WHERE n <> 1) FROM (SELECT count(DISTINCT (src_ip, dst_ip)) AS n FROM j "
            "GROUP BY sa, da)) AS collisions, "
            f"(SELECT count(*) FILTER (WHERE substr(sha256(g.ip || '{PUBLISHED_SALT}'), 1, 16) <> k.h) "
            "FROM (SELECT src_ip AS ip, sa AS h FROM j UNION ALL SELECT dst_ip, da FROM j) k JOIN g USING (ip)) AS known_bad)")
    pairs = [("row_count_preserved", "b_rows", "a_rows"), ("unique_src_preserved", "b_src", "a_src"),
             ("unique_dst_preserved", "b_dst", "a_dst"), ("src_completeness", "b_src_nn", "a_src_nn"),
             ("dst_completeness", "b_dst_nn", "a_dst_nn"),
             *[(f"intact_{c}", f"b_nn_{c}", f"a_nn_{c}") for c in analytic],
             ("hash_format_src", "0", "bad_src"), ("hash_format_dst", "0", "bad_dst"),
             ("no_address_leak", "0", "leaks"), ("relation_preserved", "0", "broken"),
             ("no_pair_collision", "0", "collisions"), ("known_vectors", "0", "known_bad")]
    sel = " UNION ALL ".join(
        f"SELECT '{n}' AS check, CAST({e} AS BIGINT) AS expected, CAST({v} AS BIGINT) AS actual, "
        f"CAST({e} AS BIGINT) = CAST({v} AS BIGINT) AS passed FROM m" for n, e, v in pairs)
    return _with(body, sel)


def _with(body: str, select: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + PK + ", " + body + " " + select


def _raw_export() -> str:
    v6s, v6d = "contains(src_ip, ':')", "contains(dst_ip, ':')"
    src = "CASE WHEN packet_id % 83 = 0 THEN src_ip || ',10.0.2.254' ELSE src_ip END"
    dport = "CASE WHEN packet_id % 71 = 0 THEN dst_port || ',9' ELSE dst_port END"
    return (
        'rx AS (SELECT packet_id, frame_time AS "frame.time", '
        f'CASE WHEN {v6s} THEN \'\' ELSE {src} END AS "ip.src", '
        f'CASE WHEN {v6s} THEN {src} ELSE \'\' END AS "ipv6.src", '
        f'CASE WHEN {v6d} THEN \'\' ELSE dst_ip END AS "ip.dst", '
        f'CASE WHEN {v6d} THEN dst_ip ELSE \'\' END AS "ipv6.dst", '
        f'CASE WHEN {v6s} THEN \'\' ELSE ip_proto END AS "ip.proto", '
        f'CASE WHEN {v6s} THEN ip_proto ELSE \'\' END AS "ipv6.nxt", '
        "CASE WHEN ip_proto = '6' THEN src_port ELSE '' END AS \"tcp.srcport\", "
        f"CASE WHEN ip_proto = '6' THEN {dport} ELSE '' END AS \"tcp.dstport\", "
        "CASE WHEN ip_proto = '17' THEN src_port ELSE '' END AS \"udp.srcport\", "
        f"CASE WHEN ip_proto = '17' THEN {dport} ELSE '' END AS \"udp.dstport\", "
        'length AS "frame.len", dns_query AS "dns.qry.name", '
        "CASE WHEN packet_id % 73 = 0 THEN ' ' || http_host || '  ' ELSE http_host END AS \"http.host\", "
        'http_path AS "http.request.uri", '
        "CASE WHEN packet_id % 79 = 0 THEN '\"' || user_agent || '\"' ELSE user_agent END AS \"http.user_agent\", "
        "'capture_' || strftime(make_timestamp(t_us), '%Y%m%d%H%M') || '.tsv' AS source_file FROM pk)")


def _stripped(c: str, profile: str) -> str:
    """A field without its outer blanks (integrated) or its outer quotes (modular)."""
    if profile == "integrated":
        return f"trim({c}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    return f"trim({c}, '\"')"


def _normalized(profile: str) -> str:
    f = lambda name: _stripped(f'"{name}"', profile)
    first = lambda name: f"split_part({f(name)}, ',', 1)"
    ne = lambda e: f"nullif({e}, '')"
    if profile == "integrated":
        src = f"coalesce({ne(f('ip.src'))}, {ne(f('ipv6.src'))})"
        dst = f"coalesce({ne(f('ip.dst'))}, {ne(f('ipv6.dst'))})"
        proto = label_a(f"coalesce({ne(f('ip.proto'))}, {ne(f('ipv6.nxt'))}, '')")
        sp = (f"CASE {proto} WHEN 'TCP' THEN {f('tcp.srcport')} WHEN 'UDP' THEN {f('udp.srcport')} END")
        dp = (f"CASE {proto} WHEN 'TCP' THEN {f('tcp.dstport')} WHEN 'UDP' THEN {f('udp.dstport')} END")
        length = f("frame.len")
    else:
        src, dst = ne(first("ip.src")), ne(first("ip.dst"))
        proto = label_b(f"coalesce({first('ip.proto')}, '')")
        sp = f"coalesce({ne(first('tcp.srcport'))}, {ne(first('udp.srcport'))})"
        dp = f"coalesce({ne(first('tcp.dstport'))}, {ne(first('udp.dstport'))})"
        length = f"coalesce({ne(first('frame.len'))}, '0')"
    return (
        f"nx AS (SELECT packet_id, source_file, {ne(f('frame.time'))} AS timestamp, "
        f"{src} AS src_ip, {dst} AS dst_ip, {proto} AS protocol, {ne(sp)} AS src_port, "
        f"{ne(dp)} AS dst_port, {ne(length)} AS length, {ne(f('dns.qry.name'))} AS dns_query, "
        f"{ne(f('http.host'))} AS http_host, {ne(f('http.request.uri'))} AS http_path, "
        f"{ne(f('http.user_agent'))} AS user_agent FROM rx)")


def _leak(table: str, id_col: str, text_col: str) -> str:
    p = QUAD
    return (f"SELECT {id_col} AS id, regexp_extract({text_col}, '{p}', 0) AS first_match, "
            f"len(regexp_extract_all({text_col}, '{p}', 0)) AS matches FROM {table} "
            f"WHERE regexp_matches({text_col}, '{p}')")


def _thin(window_s: int, with_protocol: bool) -> str:
    key = ["src_ip", "dst_ip"] + (["ip_proto"] if with_protocol else []) + ["src_port", "dst_port"]
    cols = "t_us, frame_time, src_ip, dst_ip, ip_proto, src_port, dst_port, length, dns_query, " \
           "http_host, http_path, user_agent"
    body = (f"d1 AS (SELECT min(packet_id) AS packet_id, {cols} FROM pk GROUP BY {cols}), "
            + _greedy("d1", key, "t_us", window_s * 1_000_000, "kept"))
    return _with(body, "SELECT packet_id, src_ip, dst_ip, ip_proto, src_port, dst_port, t_us FROM d1 "
                       "WHERE packet_id IN (SELECT packet_id FROM kept)", recursive=True)


def _rejects(profile: str) -> str:
    label = label_a if profile == "integrated" else label_b
    return _with(_x(label) + ", src AS (SELECT * FROM x)",
                 f"SELECT packet_id, coalesce({_reason(profile)}, 'ok') AS reason FROM src")


def _signals_q(profile: str) -> str:
    return _with(f"{_source(profile)}, {_ok(profile)}, {_signals(profile)}",
                 "SELECT packet_id, signals, signals <> '' AS is_attack_pattern FROM sig")


def _outcome(profile: str) -> str:
    """CTEs ending in ``o``: every exported row with its extraction outcome."""
    head = _raw_export() + ", " + _normalized(profile) + ", "
    if profile == "integrated":
        return head + (f"o AS (SELECT *, CASE WHEN {missing('src_ip')} OR {missing('dst_ip')} OR {missing('timestamp')} "
                       "THEN 'missing_address_or_time' ELSE 'kept' END AS extract_outcome FROM nx)")
    return head + _relevance_ctes("nx") + (
        ", o AS (SELECT *, CASE WHEN relevance_rule IN (3, 4, 6, 7, 8) THEN 'kept' "
        "ELSE 'rule_' || relevance_rule END AS extract_outcome FROM r)")


def _stats(profile: str) -> str:
    kept = "count(*) FILTER (WHERE extract_outcome = 'kept')"
    return _with(_outcome(profile),
                 f"SELECT coalesce(source_file, '__all__') AS source_file, count(*) AS total, {kept} AS kept, "
                 f"count(*) - {kept} AS filtered, ((count(*) - {kept}) * 20000 + count(*)) // (count(*) * 2) / 100 "
                 "AS filtered_pct FROM o GROUP BY ROLLUP (source_file)")


def _roundtrip(profile: str) -> str:
    # The rows that are written with two fields less are refused, whatever else they are.
    outcome = ("CASE WHEN packet_id % 67 = 0 THEN 'short_row' ELSE extract_outcome END" if profile == "modular"
               else "extract_outcome")
    return _with(_outcome(profile), "SELECT 'a b+' || regexp_extract(source_file, '([0-9]+)', 1) AS source_file, "
                                    f"{outcome} AS extract_outcome, count(*) AS rows FROM o GROUP BY 1, 2")


def _loads(nt: str, src: str, dst: str) -> str:
    return _with(nt, f"SELECT 2 * count(*) AS rows, count(DISTINCT {src}) AS distinct_src, count(DISTINCT {dst}) "
                     "AS distinct_dst, 2 * count(*) AS distinct_ids, CAST(0 AS BIGINT) AS broken_rows FROM nt", True)


def _spellings() -> str:
    """The instants that the spellings stand for, from the clock itself and not by parsing."""
    us = {0: "t_us", 1: "t_us", 2: "t_us // 1000000 * 1000000", 6: "t_us // 60000000 * 60000000",
          7: "t_us // 86400000000 * 86400000000"}
    whens = " ".join(f"WHEN {k} THEN {us.get(k, us[2])} * 1000" for k in range(8))
    return _with("z AS (SELECT 1)", f"SELECT packet_id, CAST(CASE packet_id % 9 {whens} END AS BIGINT) AS ns_integrated, "
                                    f"CAST(CASE packet_id % 9 {whens} END AS BIGINT) AS ns_modular, true AS valid_modular FROM pk")


def oracles() -> dict[str, str]:
    from .threat_oracles import threat_oracles  # it builds on the fragments above

    nt = _nt()
    comp_cols = ["dns_query", "http_host", "http_path", "user_agent"]
    comp = " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
        f"count(*) FILTER (WHERE {c} = '') AS empty, count({c}) AS non_null, "
        f"(count({c}) * 2000 + count(*)) // (count(*) * 2) / 10 AS non_null_pct FROM pk"
        for c in comp_cols)
    ranges = " UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM sig"
        for c in ["src_port", "dst_port", "length", "event_ns"])
    return {
        **_report_queries(nt, "dst_ip_anonimizada", ""),
        "protocol_labels": _with("z AS (SELECT 1)", f"SELECT packet_id, ip_proto, {label_a('ip_proto')} AS "
                                 f"label_integrated, {label_b('ip_proto')} AS label_modular FROM pk"),
        "normalize_integrated": _with(_raw_export() + ", " + _normalized("integrated"), "SELECT * FROM nx"),
        "normalize_modular": _with(_raw_export() + ", " + _normalized("modular"), "SELECT * FROM nx"),
        "timestamp_parse": _with("z AS (SELECT 1)", f"SELECT packet_id, {ns_a('frame_time')} AS ns_integrated, "
                                 f"{ns_b('frame_time')} AS ns_modular FROM pk"),
        "relevance_rules": _with(_x(label_b) + ", " + _relevance_ctes("x"),
                                 "SELECT packet_id, relevance_rule, relevance_rule IN (3, 4, 6, 7, 8) "
                                 "AS relevant FROM r"),
        "internal_split": _with("z AS (SELECT 1)", f"SELECT packet_id, {internal('src_ip')} AS src_internal, "
                                f"{internal('dst_ip')} AS dst_internal FROM pk"),
        "reject_reasons_integrated": _rejects("integrated"),
        "reject_reasons_modular": _rejects("modular"),
        "port_scanners": _with("z AS (SELECT 1)", f"SELECT src_ip, count(DISTINCT {port_val('dst_port')}) AS "
                               f"distinct_dst_ports FROM pk WHERE {port_val('dst_port')} IS NOT NULL "
                               f"GROUP BY src_ip HAVING count(DISTINCT {port_val('dst_port')}) > "
                               f"{K.PORT_SCAN_MIN_DISTINCT}"),
        "signals_integrated": _signals_q("integrated"),
        "signals_modular": _signals_q("modular"),
        "exact_dedup": _with("z AS (SELECT 1)", "SELECT min(packet_id) AS packet_id, t_us, frame_time, src_ip, "
                             "dst_ip, ip_proto, src_port, dst_port, length, dns_query, http_host, http_path, "
                             "user_agent FROM pk GROUP BY ALL"),
        "first_per_tuple": _with("z AS (SELECT 1)", "SELECT src_ip, dst_ip, src_port, dst_port, packet_id, t_us "
                                 "FROM pk QUALIFY row_number() OVER (PARTITION BY src_ip, dst_ip, src_port, "
                                 "dst_port ORDER BY t_us NULLS LAST, packet_id) = 1"),
        "flow_thin_60s": _thin(60, True),
        "flow_thin_1s": _thin(1, False),
        "pseudonyms_salt_first": _with("z AS (SELECT 1)", f"SELECT ip, {_hash('ip', True)} AS pseudonym FROM "
                                       "(SELECT src_ip AS ip FROM pk UNION SELECT dst_ip FROM pk) "
                                       "WHERE ip IS NOT NULL AND ip <> ''"),
        "pseudonyms_salt_last": _with("z AS (SELECT 1)", f"SELECT ip, {_hash('ip', False)} AS pseudonym FROM "
                                      "(SELECT src_ip AS ip FROM pk UNION SELECT dst_ip FROM pk) "
                                      "WHERE ip IS NOT NULL AND ip <> ''"),
        "ip_leak_scan": _leak("documents", "doc_id", "text"),
        "ip_leak_scan_pages": _leak("pages", "page_id", "html"),
        "ip_leak_scan_conversations": _leak("conversations", "conv_id", "text"),
        "distinct_endpoints": _with("z AS (SELECT 1)", "SELECT count(DISTINCT src_ip) AS distinct_src, "
                                    "count(DISTINCT dst_ip) AS distinct_dst FROM pk"),
        "value_ranges": _with(f"{_source('integrated')}, {_ok('integrated')}, {_signals('integrated')}", ranges),
        "completeness": _with("z AS (SELECT 1)", comp),
        "extraction_stats": _stats("modular"),
        "extraction_stats_integrated": _stats("integrated"),
        "export_roundtrip_integrated": _roundtrip("integrated"),
        "export_roundtrip_modular": _roundtrip("modular"),
        "export_rows_per_file": _with(_outcome("modular"), "SELECT 'a b+' || regexp_extract(source_file, '([0-9]+)', 1) AS source_file, "
                                      "count(*) AS rows, count(*) FILTER (WHERE packet_id % 67 = 0) AS short_rows FROM o GROUP BY 1"),
        "replayed_load_checks": _with(_nt_modular(), "SELECT 2 * count(*) AS rows, count(DISTINCT src_ip_anon) AS distinct_src, "
                                      "count(DISTINCT dst_ip_anon) AS distinct_dst, 2 * count(*) AS distinct_ids, "
                                      "CAST(0 AS BIGINT) AS broken_rows, 2 * count(*) AS kept_ids FROM nt", True),
        "clustered_lookups": _clustered_lookups(),
        "service_share": _service_share(nt),
        "large_packets": _with(nt, "SELECT packet_id, src_ip_anonimizada, dst_ip_anonimizada, protocol, dst_port, length FROM nt "
                                   f"WHERE length > {K.LARGE_PACKET_BYTES}", True),
        **threat_oracles(),
        "load_checks_integrated": _loads(nt, "src_ip_anonimizada", "dst_ip_anonimizada"),
        "load_checks_modular": _loads(_nt_modular(), "src_ip_anon", "dst_ip_anon"),
        "stage_roundtrip": _with(_nt_modular(), "SELECT packet_id, src_ip_anon, dst_port, length, dns_query FROM nt", True),
        "timestamp_spellings": _spellings(),
        "hash_distribution": _with(nt, "SELECT CAST(count(*) // 2 AS BIGINT) AS rows_processed, count(h) AS hashes, "
                                       "count(DISTINCT h) AS unique_hashes, count(*) - count(h) AS missing_addresses FROM "
                                       "(SELECT nullif(src_ip_anonimizada, '') AS h FROM nt UNION ALL "
                                       "SELECT nullif(dst_ip_anonimizada, '') FROM nt)", True),
        "protocol_distribution": _with(nt, "SELECT protocol, count(*) AS count FROM nt GROUP BY protocol", True),
        "distinct_ports_per_source": _with("z AS (SELECT 1)", f"SELECT src_ip, count(DISTINCT "
                                           f"{port_val('dst_port')}) AS distinct_dst_ports FROM pk GROUP BY src_ip"),
        "extraction_top_protocols": _with(_source("modular"), "SELECT protocol, count(*) AS count FROM src "
                                          "GROUP BY protocol ORDER BY count DESC, protocol NULLS FIRST LIMIT 5"),
        "value_ranges_modular": _with(
            f"{_source('modular')}, {_ok('modular')}",
            " UNION ALL ".join(f"SELECT '{c}' AS column, CAST(min({c}) AS VARCHAR) AS min_value, "
                               f"CAST(max({c}) AS VARCHAR) AS max_value FROM ok"
                               for c in ["timestamp", "src_port", "dst_port"])),
        "missing_counts": _with("z AS (SELECT 1)", "SELECT " + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS {c}_missing" for c in TEXT) + " FROM pk"),
        **_report_queries(_nt_modular(), "dst_ip_anon", "_modular"),
        "clean_counters_integrated": _counters("integrated"),
        "clean_counters_modular": _counters("modular"),
        "pseudonym_checks": _pseudonym_checks(),
        "cleaned_rows_integrated": _with(_clean("integrated"), f"SELECT {OUT_COLS} FROM cl", True),
        "cleaned_rows_modular": _with(_clean("modular"), f"SELECT {OUT_COLS} FROM cl", True),
        "cleaned_rows_keep_flagged_modular": _with(_clean("modular", keep_flagged=True),
                                                   f"SELECT {OUT_COLS} FROM cl", True),
    }
