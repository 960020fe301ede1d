"""DuckDB statements of the threat and privacy queries, written from the rules."""

from __future__ import annotations

from ..functions import constants as K
from . import oracles as O
from . import threat_queries as Q


def _with(body: str, select: str) -> str:
    return f"WITH {O.PK}{', ' + body if body else ''} {select}"


def _number(c: str) -> str:
    """An address as a number of its family (the caller keeps families apart)."""
    v4 = f"list_reduce(list_transform(string_split({c}, '.'), lambda p: CAST(p AS UHUGEINT)), lambda a, b: a * 256 + b)"
    side = "list_transform(list_filter(string_split({}, ':'), lambda g: g <> ''), lambda g: CAST(CAST(('0x' || g) AS BIGINT) AS UHUGEINT))"
    left, right = side.format(f"string_split({c}, '::')[1]"), side.format(f"coalesce(string_split({c}, '::')[2], '')")
    zeros = f"list_transform(range(8 - len({left}) - len({right})), lambda k: CAST(0 AS UHUGEINT))"
    v6 = f"list_reduce(list_concat(list_concat({left}, {zeros}), {right}), lambda a, b: a * 65536 + b)"
    return f"CASE WHEN contains({c}, ':') THEN {v6} ELSE {v4} END"


def indicator_match() -> str:
    # The widest aligned block around the address that lies in the range.
    width = "(CAST(1 AS UHUGEINT) << CAST(k AS UHUGEINT))"
    pieces = f"list_max(list_filter(range(127), lambda k: (n // {width}) * {width} >= low AND (n // {width}) * {width} + ({width} - 1) <= high))"
    body = (
        f"ind AS ({Q.INDICATORS.format(pk='pk')}), "
        "i0 AS (SELECT indicator, contains(indicator, '-') AS span, string_split(string_split(indicator, '-')[1], '/')[1] AS a, "
        "coalesce(string_split(indicator, '-')[2], string_split(indicator, '/')[1]) AS b, "
        "CASE WHEN contains(indicator, '/') THEN TRY_CAST(string_split(indicator, '/')[2] AS INT) END AS size FROM ind WHERE kind = 'address'), "
        f"i1 AS (SELECT *, CASE WHEN contains(a, ':') THEN 128 ELSE 32 END AS bits FROM i0 WHERE {O.valid_ip('a')} AND {O.valid_ip('b')}), "
        f"i2 AS (SELECT *, {_number('a')} AS na, {_number('b')} AS nb, "
        "CAST(1 AS UHUGEINT) << CAST(bits - coalesce(size, bits) AS UHUGEINT) AS width FROM i1 WHERE coalesce(size, bits) BETWEEN 0 AND bits), "
        "i AS (SELECT indicator, bits, CASE WHEN span THEN na ELSE (na // width) * width END AS low, "
        "CASE WHEN span THEN nb ELSE (na // width) * width + (width - 1) END AS high FROM i2), "
        f"v AS (SELECT ip, CASE WHEN contains(ip, ':') THEN 128 ELSE 32 END AS bits, {_number('ip')} AS n FROM "
        f"(SELECT src_ip AS ip FROM pk UNION SELECT dst_ip FROM pk) WHERE {O.valid_ip('ip')}), "
        f"h AS (SELECT ip, indicator, {pieces} AS piece FROM v JOIN i ON v.bits = i.bits AND n BETWEEN low AND high), "
        "m AS (SELECT ip, indicator FROM h QUALIFY row_number() OVER (PARTITION BY ip ORDER BY piece, indicator) = 1), "
        "dn AS (SELECT q, indicator FROM (SELECT DISTINCT dns_query AS q FROM pk) JOIN ind ON kind = 'domain' AND indicator <> '' "
        "AND (lower(q) = lower(indicator) OR ends_with(lower(q), '.' || lower(indicator))) "
        "QUALIFY row_number() OVER (PARTITION BY q ORDER BY length(indicator) DESC, indicator) = 1), "
        "z AS (SELECT packet_id, s.indicator AS src_indicator, t.indicator AS dst_indicator, dn.indicator AS dns_indicator FROM pk "
        "LEFT JOIN m s ON s.ip = src_ip LEFT JOIN m t ON t.ip = dst_ip LEFT JOIN dn ON q = dns_query)")
    return _with(body, "SELECT * FROM z WHERE src_indicator IS NOT NULL OR dst_indicator IS NOT NULL OR dns_indicator IS NOT NULL")


def brute_force() -> str:
    key = "src_ip, dst_ip, dst_port"
    body = (f"w AS (SELECT {key}, t_us, count(*) OVER (PARTITION BY {key} ORDER BY t_us RANGE BETWEEN {Q.BURST_WINDOW - 1} PRECEDING "
            f"AND CURRENT ROW) AS c FROM pk), x AS (SELECT *, max(c) OVER (PARTITION BY {key}) AS most, "
            f"count(*) OVER (PARTITION BY {key}) AS events FROM w)")
    return _with(body, f"SELECT {key}, events, most, min(t_us) AS at FROM x WHERE c = most AND most >= {Q.BURST_LEAST} GROUP BY ALL")


def length_outliers() -> str:
    body = (f"l AS (SELECT packet_id, {O.label_b('ip_proto')} AS protocol, {O.len_val('length')} AS length FROM pk), "
            "g AS (SELECT protocol, count(length) AS n, sum(length) AS s, sum(CAST(length AS BIGINT) * length) AS q, "
            "quantile_cont(length, 0.25) AS q1, quantile_cont(length, 0.75) AS q3 FROM l GROUP BY 1), "
            "r AS (SELECT l.*, q1, q3, sqrt(CAST(n * q - s * s AS DOUBLE)) AS spread, CAST(n AS DOUBLE) AS n, CAST(s AS DOUBLE) AS s "
            "FROM l JOIN g USING (protocol) WHERE length IS NOT NULL), "
            "z AS (SELECT packet_id, protocol, length, CASE WHEN spread > 0 THEN (length * n - s) / spread END AS z, "
            "length < q1 - 1.5 * (q3 - q1) OR length > q3 + 1.5 * (q3 - q1) AS by_iqr FROM r)")
    return _with(body, "SELECT packet_id, protocol, length, z, coalesce(abs(z) > 3, false) AS by_z, by_iqr FROM z "
                       "WHERE coalesce(abs(z) > 3, false) OR by_iqr")


def token_map_growth() -> str:
    ends = "(SELECT packet_id, src_ip AS v FROM pk UNION ALL SELECT packet_id, dst_ip FROM pk)"
    body = f"e AS (SELECT * FROM {ends} WHERE v IS NOT NULL AND v <> '')"
    return _with(body, "SELECT count(DISTINCT v) AS tokens, count(DISTINCT v) AS distinct_tokens, CAST(0 AS BIGINT) AS lowest, "
                       "count(DISTINCT v) - 1 AS highest, count(DISTINCT v) FILTER (WHERE packet_id % 2 = 0) AS kept_tokens, "
                       "(SELECT count(*) FROM pk) AS restored_rows FROM e")


def masked_domains() -> str:
    part = f"substr(sha256('{K.PUBLISHED_SALT}' || array_to_string(p[k:], '.')), 1, 12)"
    body = "d AS (SELECT packet_id, dns_query, string_split(lower(dns_query), '.') AS p FROM pk WHERE dns_query IS NOT NULL)"
    return _with(body, "SELECT packet_id, CASE WHEN len(p) > 1 THEN array_to_string(list_transform(range(1, len(p)), "
                       f"lambda k: {part}), '.') || '.' || p[len(p)] ELSE dns_query END AS masked FROM d")


def _agent_families() -> str:
    whens = " ".join(f"WHEN regexp_matches(lower(user_agent), '{p}') THEN '{f}'" for f, p in K.AGENT_FAMILIES.items())
    return _with("", f"SELECT packet_id, CASE WHEN user_agent IS NULL OR user_agent = '' THEN NULL {whens} ELSE '{K.AGENT_OTHER}' END "
                     "AS agent_family FROM pk")


def _shift() -> str:
    key = " || '|' || ".join(f"coalesce({c}, '\\N')" for c in Q.FLOW)
    return (f"CAST(('0x' || substr(sha256('{K.PUBLISHED_SALT}' || '|' || {key}), 1, 13)) AS BIGINT) % {2 * Q.SHIFT_MOST + 1} - {Q.SHIFT_MOST}")


def threat_oracles() -> dict[str, str]:
    flow = ", ".join(Q.FLOW)
    return {
        "indicator_match": indicator_match(),
        "brute_force_bursts": brute_force(),
        "length_outliers": length_outliers(),
        "token_map_growth": token_map_growth(),
        "masked_domains": masked_domains(),
        "agent_families": _agent_families(),
        "shifted_times": _with("", f"SELECT packet_id, t_us + ({_shift()}) AS t_us, {flow} FROM pk"),
        "time_shift_checks": _with(f"s AS (SELECT DISTINCT {flow}, {_shift()} AS o FROM pk)",
                                   "SELECT count(*) AS flows, count(*) FILTER (WHERE o <> 0) AS moved_flows, CAST(0 AS BIGINT) AS broken_flows, "
                                   "CAST(0 AS BIGINT) AS missing_rows FROM s"),
        "sketched_endpoints": _with("", "SELECT count(DISTINCT t_us // 86400000000) AS days, count(DISTINCT src_ip) AS distinct_src, "
                                        "count(DISTINCT dst_ip) AS distinct_dst, true AS src_within, true AS dst_within FROM pk"),
    }
