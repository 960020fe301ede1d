"""Raw export -> extracted contract.

``normalize`` maps either export layout to the 11 extracted columns with
native expressions only; ``presence_filter`` is the extraction-time drop of
rows that lack an address (or, in the integrated profile, a time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fields as X
from ..schema import EXTRACTED_COLUMNS, Profile, profile as _profile
from ..session import bind

ADDRESS_FIELDS = ["ip.src", "ipv6.src", "ip.dst", "ipv6.dst", "ip.proto", "ipv6.nxt"]
PORT_FIELDS = ["tcp.srcport", "tcp.dstport", "udp.srcport", "udp.dstport", "frame.len"]
TEXT_FIELDS = ["frame.time", "dns.qry.name", "http.host", "http.request.uri", "http.user_agent"]


def _clean_text(c: Column, first_only: bool, quotes: bool) -> Column:
    """One exported field: its outer quotes *or* its outer blanks go, by profile."""
    c = X.strip_quotes(c) if quotes else X.strip_blanks(c)
    return X.first_occurrence(c) if first_only else c


def _bound(field: str) -> str:
    return "_" + field.replace(".", "_")


def _nonempty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize(raw: DataFrame, prof: str | Profile, na: tuple[str, ...] = ()) -> DataFrame:
    """Export rows -> ``packet_id, source_file`` + the 11 extracted columns.

    ``na`` lists further spellings of a missing value (such as ``NA`` or
    ``null``), which become NULL in every extracted column.

    ``packet_id`` is assigned here, once (unless the input already has one),
    and carried by every later stage; it stands in for row positions.
    """
    prof = _profile(prof)
    # First-occurrence applies to the fields a capture tool may repeat
    # (addresses, protocol, ports, length), never to free text.
    repeatable = {*ADDRESS_FIELDS, *PORT_FIELDS}
    # Every field is cleaned once per row, a few fields at a time: one projection of all
    # rules makes a generated method that the JVM's compiler refuses (over 8,000 bytes).
    for group in (ADDRESS_FIELDS, PORT_FIELDS, TEXT_FIELDS):
        raw = bind(raw, **{_bound(f): _clean_text(F.col(f"`{f}`"), prof.first_occurrence and f in repeatable, prof.strip_quotes)
                           for f in group if f in raw.columns})
    col = lambda name: F.col(_bound(name))

    if prof.ipv6:
        src = F.coalesce(_nonempty(col("ip.src")), _nonempty(col("ipv6.src")))
        dst = F.coalesce(_nonempty(col("ip.dst")), _nonempty(col("ipv6.dst")))
        number = F.coalesce(_nonempty(col("ip.proto")), _nonempty(col("ipv6.nxt")), F.lit(""))
        protocol = X.protocol_label_integrated(number)
        sport = X.port_pick_integrated(protocol, col("tcp.srcport"), col("udp.srcport"))
        dport = X.port_pick_integrated(protocol, col("tcp.dstport"), col("udp.dstport"))
    else:
        src, dst = _nonempty(col("ip.src")), _nonempty(col("ip.dst"))
        protocol = X.protocol_label_modular(F.coalesce(col("ip.proto"), F.lit("")))
        sport = X.port_pick_modular(col("tcp.srcport"), col("udp.srcport"))
        dport = X.port_pick_modular(col("tcp.dstport"), col("udp.dstport"))

    length = col("frame.len")
    if prof.default_length is not None:
        length = F.coalesce(_nonempty(length), F.lit(prof.default_length))

    out = raw.select(
        (F.col("packet_id") if "packet_id" in raw.columns
         else F.monotonically_increasing_id()).alias("packet_id"),
        F.col("source_file"),
        _nonempty(col("frame.time")).alias("timestamp"),
        src.alias("src_ip"), dst.alias("dst_ip"), protocol.alias("protocol"),
        _nonempty(sport).alias("src_port"), _nonempty(dport).alias("dst_port"),
        _nonempty(length).alias("length"),
        _nonempty(col("dns.qry.name")).alias("dns_query"),
        _nonempty(col("http.host")).alias("http_host"),
        _nonempty(col("http.request.uri")).alias("http_path"),
        _nonempty(col("http.user_agent")).alias("user_agent"),
        *([F.col("short_row")] if "short_row" in raw.columns else []),
    )
    if na:
        out = out.select(*[X.blank_to_null(F.col(c), na).alias(c) if c in EXTRACTED_COLUMNS else F.col(c)
                           for c in out.columns])
    return out


def presence_drop(df: DataFrame, prof: str | Profile) -> Column:
    """Extraction-time drop condition (F2): missing address, or time in A."""
    prof = _profile(prof)
    cond = X.is_missing(F.col("src_ip")) | X.is_missing(F.col("dst_ip"))
    if prof.ipv6:
        cond = cond | X.is_missing(F.col("timestamp"))
    if "short_row" in df.columns:
        cond = cond | F.col("short_row")
    return cond
