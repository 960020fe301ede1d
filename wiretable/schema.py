"""Schemas of every stage and the two rule profiles.

Schemas are explicit ``StructType``s (never inferred).  A ``Profile`` bundles
every rule choice that differs between the two pipelines the engine offers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .functions import constants as K


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Field export with IPv4 and IPv6 columns (tab separated).
RAW16_FIELDS = [
    "frame.time", "ip.src", "ipv6.src", "ip.dst", "ipv6.dst", "ip.proto", "ipv6.nxt",
    "tcp.srcport", "tcp.dstport", "udp.srcport", "udp.dstport", "frame.len",
    "dns.qry.name", "http.host", "http.request.uri", "http.user_agent",
]
# Field export, IPv4 only (quoted CSV).
RAW13_FIELDS = [
    "frame.time", "ip.src", "ip.dst", "ip.proto", "tcp.srcport", "tcp.dstport",
    "udp.srcport", "udp.dstport", "frame.len", "dns.qry.name", "http.host",
    "http.request.uri", "http.user_agent",
]
RAW16 = _strings(RAW16_FIELDS)
RAW13 = _strings(RAW13_FIELDS)

# The 11-column contract shared by the extracted and cleaned stages.
EXTRACTED_COLUMNS = [
    "timestamp", "src_ip", "dst_ip", "protocol", "src_port", "dst_port", "length",
    "dns_query", "http_host", "http_path", "user_agent",
]
REQUIRED_COLUMNS = ["timestamp", "src_ip", "dst_ip", "protocol"]


@dataclass(frozen=True)
class Profile:
    """Every rule that differs between the two pipelines."""

    name: str
    ipv6: bool                      # coalesce IPv6 fields into the address columns
    relevance_filter: bool          # run the relevance cascade at extraction
    first_occurrence: bool          # keep the first of a repeated field
    strip_quotes: bool              # outer quotes of a field go (else its outer blanks)
    flow_window_s: float            # greedy flow-thinning window
    flow_key_with_protocol: bool    # flow key includes the protocol label
    hash_salt_first: bool           # sha256(salt||ip) vs sha256(ip||salt)
    hash_missing_as_empty: bool     # '' (integrated) or NULL (modular) pseudonym
    default_length: str | None      # missing frame length replaced by this text
    length_required: bool           # the loaded table refuses rows without a length
    anon_columns: tuple[str, str] = field(default=("src_ip_anon", "dst_ip_anon"))
    capture_globs: tuple[str, ...] = ()

    @property
    def flow_key(self) -> list[str]:
        key = ["src_ip", "dst_ip"]
        if self.flow_key_with_protocol:
            key.append("protocol")
        return key + ["src_port", "dst_port"]

    @property
    def not_null(self) -> list[str]:
        """Columns that the loaded table may not lack."""
        length = ["length"] if self.length_required else []
        return ["timestamp", *self.anon_columns, "protocol", *length]

    @property
    def layout(self) -> list[str]:
        """Sort order inside the loaded table's files."""
        return [self.anon_columns[1], self.anon_columns[0], "protocol"]

    @property
    def flow_window_ns(self) -> int:
        return int(round(self.flow_window_s * 1_000_000_000))


INTEGRATED = Profile(
    name="integrated", ipv6=True, relevance_filter=False, first_occurrence=False, strip_quotes=False,
    flow_window_s=K.FLOW_WINDOW_INTEGRATED_S, flow_key_with_protocol=True,
    hash_salt_first=False, hash_missing_as_empty=True, default_length=None, length_required=False,
    anon_columns=("src_ip_anonimizada", "dst_ip_anonimizada"),
    capture_globs=tuple(K.CAPTURE_GLOBS_INTEGRATED),
)
MODULAR = Profile(
    name="modular", ipv6=False, relevance_filter=True, first_occurrence=True, strip_quotes=True,
    flow_window_s=K.FLOW_WINDOW_MODULAR_S, flow_key_with_protocol=False,
    hash_salt_first=True, hash_missing_as_empty=False, default_length="0", length_required=True,
    anon_columns=("src_ip_anon", "dst_ip_anon"),
    capture_globs=tuple(K.CAPTURE_GLOBS_MODULAR),
)
PROFILES = {p.name: p for p in (INTEGRATED, MODULAR)}


def profile(name_or_profile: str | Profile) -> Profile:
    if isinstance(name_or_profile, Profile):
        return name_or_profile
    return PROFILES[name_or_profile]
