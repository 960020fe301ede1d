"""Field expressions: protocols, ports, timestamps, pseudonyms.

All are native Column expressions (codegen-friendly, no Python UDFs).  Raw
capture text is handled with ``try_*`` casts because ANSI mode is on by
default and junk must yield NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

# --------------------------------------------------------------------------- text


def blank_to_null(c: Column, tokens: tuple[str, ...] = ("",)) -> Column:
    """Missing-value normalisation: the given tokens become NULL."""
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def is_missing(c: Column) -> Column:
    """The rule sets treat NULL and the empty string alike as "missing"."""
    return c.isNull() | (c == "")


def strip_quotes(c: Column) -> Column:
    return F.when(c.contains('"'), F.regexp_replace(c, '^"+|"+$', "")).otherwise(c)


def strip_blanks(c: Column) -> Column:
    """Without white space at both ends (blanks, tabs, line ends)."""
    return F.btrim(c, F.lit(" \t\n\r\u000b\f"))


def first_occurrence(c: Column) -> Column:
    """Keep the first value of a repeated field exported as ``a,b``."""
    return F.substring_index(c, ",", 1)


# ---------------------------------------------------------------------- protocols


def _case_map(c: Column, mapping: dict[str, str], default: Column) -> Column:
    expr = None
    for key, label in mapping.items():
        expr = F.when(c == key, label) if expr is None else expr.when(c == key, label)
    return expr.otherwise(default)


def protocol_label_integrated(number: Column) -> Column:
    """6 TCP, 17 UDP, 1 ICMP, 58 ICMPv6, anything else OTHER."""
    return _case_map(number, K.PROTOCOL_LABELS_INTEGRATED, F.lit(K.PROTOCOL_OTHER_INTEGRATED))


def protocol_label_modular(number: Column) -> Column:
    """IANA label for common numbers, else ``PROTO-<n>`` (``PROTO-`` if missing)."""
    return _case_map(number, K.PROTOCOL_LABELS_MODULAR,
                     F.concat(F.lit(K.PROTOCOL_PREFIX_MODULAR), F.coalesce(number, F.lit(""))))


def protocol_whitelisted_integrated(protocol: Column) -> Column:
    return F.coalesce(protocol.isin(*K.PROTOCOL_WHITELIST_INTEGRATED), F.lit(False))


def protocol_whitelisted_modular(protocol: Column) -> Column:
    return F.coalesce(F.upper(F.trim(protocol)).isin(*K.PROTOCOL_WHITELIST_MODULAR), F.lit(False))


# -------------------------------------------------------------------------- ports


def port_pick_integrated(protocol: Column, tcp: Column, udp: Column) -> Column:
    """Ports follow the protocol: TCP fields for TCP, UDP for UDP, else none."""
    return (F.when(protocol == "TCP", tcp).when(protocol == "UDP", udp)
            .otherwise(F.lit(None).cast("string")))


def port_pick_modular(tcp: Column, udp: Column) -> Column:
    """TCP field when present, else the UDP one, whatever the protocol."""
    return F.coalesce(F.nullif(tcp, F.lit("")), F.nullif(udp, F.lit("")))


def port_number(c: Column) -> Column:
    """Number of a port's text; bind it where several rules read it."""
    return c.try_cast("double")


def port_is_valid(c: Column, nan_text_is_missing: bool = False, number: Column | None = None) -> Column:
    """NULL/empty is valid; otherwise ``int(float(x))`` must lie in 0..65535.

    ``int(float(x))`` is in range exactly when ``-1 < x < 65536``; NaN and
    infinities fail the comparison, junk fails the cast.
    """
    missing = is_missing(c)
    if nan_text_is_missing:
        missing = missing | (c == "nan")
    d = port_number(c) if number is None else number
    return missing | F.coalesce((d > -1) & (d < 65536), F.lit(False))


def port_value(c: Column, number: Column | None = None) -> Column:
    """Typed port: truncated integer of the text, NULL when missing or invalid."""
    d = port_number(c) if number is None else number
    return F.when((d > -1) & (d < 65536), d.cast("int"))


def integer_text_value(c: Column) -> Column:
    """Value of ``int(text)`` for integer literals, NULL for anything else.

    Out-of-range literals map to -1, which no port set contains.  A text that its own
    number gives back needs no pattern.
    """
    number = c.try_cast("bigint")
    return F.when(c == number.cast("string"), number).when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"),
                  F.coalesce(F.trim(c).try_cast("bigint"), F.lit(-1).cast("bigint")))


# ---------------------------------------------------------------------- timestamps

# Generic parser, as an ordered format list: month names first, then ISO, then
# month-first and day-first numbers (an ambiguous date is month first).  One- and
# two-digit fields are both read; seconds and a fraction of up to 9 digits are
# optional; a zone offset has been removed before.
_CLOCK = "H:m[:s][.SSSSSSSSS]"
FLEX_FORMATS = [
    f"MMM d, yyyy {_CLOCK}", f"MMMM d, yyyy {_CLOCK}",
    f"d MMM yyyy {_CLOCK}", f"d MMMM yyyy {_CLOCK}",
    f"yyyy-M-d {_CLOCK}", f"yyyy-M-d'T'{_CLOCK}",
    f"M/d/yyyy {_CLOCK}", f"d/M/yyyy {_CLOCK}",
    "yyyy-M-d", "MMM d, yyyy", "MMMM d, yyyy", "M/d/yyyy", "d/M/yyyy",
]
# Strict list of the modular validator, fraction already cut to 6 digits.
MODULAR_FORMATS = K.MODULAR_TIME_FORMATS
# `Z` or an offset behind a clock time: removed, not applied, like a zone abbreviation.
ZONE_OFFSET_PATTERN = r"(:[0-9]{1,2}([.][0-9]+)?)\s*(Z|[+-][0-9]{2}:?[0-9]{2})$"


def parse_formats(text: Column, formats: list[str]) -> Column:
    """First format that parses ``text`` (pass a column reference: the text is
    read once per format)."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


#: Signs that a format has, and with it each text that it parses; the first one found decides.
_SIGNS = [("/", lambda c: c.contains("/")), (",", lambda c: c.contains(",")),
          ("MMM", lambda c: c.rlike("[A-SU-Za-su-z]")), ("'T'", lambda c: c.rlike("[Tt]"))]


def parse_by_signs(text: Column, formats: list[str]) -> Column:
    """``parse_formats`` with the formats that can apply, at most two of these lists.

    Only month-first and day-first numbers have a slash, only month names in
    front a comma, only month names a letter other than ``T``, only clock times
    a colon.
    """
    left, parsed = list(formats), None
    for sign, found in [*_SIGNS, ("", None)]:
        own = [f for f in left if sign in f]
        left = [f for f in left if f not in own]
        timed, bare = [f for f in own if ":" in f], [f for f in own if ":" not in f]
        one = F.when(text.contains(":"), parse_formats(text, timed) if timed else F.lit(None).cast("timestamp"))
        one = one.otherwise(parse_formats(text, bare)) if bare else one
        if found is None:
            return parsed.otherwise(one)
        parsed = (F if parsed is None else parsed).when(found(text), one)


def _any_in(c: Column, signs: str | list[str]) -> Column:
    found = c.contains(signs[0])
    for s in signs[1:]:
        found = found | c.contains(s)
    return found


def squash_blanks(c: Column) -> Column:
    """Single blanks, and no zone offset at the end.

    The patterns are only tried on texts with a sign that they need.
    """
    blanks = _any_in(c, ["  ", *"\t\n\r\u000b\f"])
    single = F.when(blanks, F.regexp_replace(c, r"\s+", " ")).otherwise(c)
    return F.trim(F.when(_any_in(c, "Z+-"), F.regexp_replace(single, ZONE_OFFSET_PATTERN, "$1")).otherwise(single))


def cut_fraction(c: Column) -> Column:
    """Fraction digits beyond the sixth are dropped (microsecond parsers)."""
    return F.regexp_replace(c, r"[.]([0-9]{6})[0-9]+", ".$1")


def time_text_integrated(raw: Column) -> Column:
    """Quotes stripped and a trailing zone abbreviation removed (not applied)."""
    return F.regexp_replace(strip_quotes(raw), K.ZONE_SUFFIX_PATTERN, "")


def time_text_modular(raw: Column) -> Column:
    """Trimmed, with the first matching CEST/CET/UTC suffix removed."""
    s = F.trim(raw)
    expr = None
    for zone in K.MODULAR_ZONE_SUFFIXES:
        step = F.replace(s, F.lit(zone), F.lit(""))
        expr = F.when(s.contains(zone), step) if expr is None else expr.when(s.contains(zone), step)
    return expr.otherwise(s)


def parse_time_integrated(raw: Column) -> Column:
    """Parsed wall clock (TIMESTAMP, UTC session) or NULL when unparseable."""
    return parse_by_signs(squash_blanks(time_text_integrated(raw)), FLEX_FORMATS)


def parse_time_modular(raw: Column) -> Column:
    """Generic parse (month first on ambiguous dates), then the validator's own list."""
    text = time_text_modular(raw)
    return F.coalesce(parse_by_signs(squash_blanks(text), FLEX_FORMATS),
                      parse_by_signs(cut_fraction(text), MODULAR_FORMATS))


def fraction_digits(text: Column) -> Column:
    return F.regexp_extract(text, r"[.]([0-9]+)", 1)


def time_ns_from(ts: Column, frac: Column) -> Column:
    """Nanoseconds since the epoch: micros of the parsed value + sub-µs digits.

    Spark timestamps hold microseconds; the 7th-9th fraction digits of the
    text are added back so that window arithmetic is exact in nanoseconds.
    """
    sub_us = F.when(F.length(frac) > 6, F.rpad(F.substring(frac, 7, 3), 3, "0").cast("long")) \
        .otherwise(F.lit(0).cast("long"))
    # NULL beyond the range of 64-bit nanoseconds (years 1678 to 2261), never an error.
    return F.try_add(F.try_multiply(F.unix_micros(ts), F.lit(1000).cast("long")), sub_us)


def time_ns(ts: Column, text: Column) -> Column:
    return time_ns_from(ts, fraction_digits(text))


# ----------------------------------------------------------------------- pseudonyms


def pseudonym(ip: Column, salt: str, salt_first: bool, missing_as_empty: bool) -> Column:
    """First 16 hex characters of SHA-256 over the address and a salt.

    ``salt_first`` selects ``salt || ip`` (modular) or ``ip || salt``
    (integrated); missing addresses give ``''`` or NULL per profile.
    """
    material = F.concat(F.lit(salt), ip) if salt_first else F.concat(ip, F.lit(salt))
    hashed = F.substring(F.sha2(material, 256), 1, K.PSEUDONYM_HEX_CHARS)
    missing = F.lit("") if missing_as_empty else F.lit(None).cast("string")
    return F.when(is_missing(ip), missing).otherwise(hashed)
