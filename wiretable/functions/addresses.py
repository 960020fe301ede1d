"""Address expressions: validity (IPv4/IPv6) and the internal-address rule.

Validity follows the standard textual forms: strict dotted quad without
leading zeros, and every RFC 4291 IPv6 form (``::`` compression, embedded
IPv4 tail, optional ``%scope``).  The pattern is generated from the grammar
and is plain regex text, so the same string runs in Spark (Java regex) and in
DuckDB (RE2).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

_HEX = "[0-9A-Fa-f]{1,4}"
_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_V4 = f"{_OCTET}([.]{_OCTET}){{3}}"


def _ipv6_alternatives() -> list[str]:
    alts = [f"({_HEX}:){{7}}{_HEX}", f"({_HEX}:){{6}}{_V4}"]
    for before in range(8):            # groups written before the "::"
        pre = "" if before == 0 else f"{_HEX}(:{_HEX}){{{before - 1}}}"
        if before == 7:
            alts.append(f"{pre}::")
        else:
            alts.append(f"{pre}::({_HEX}(:{_HEX}){{0,{6 - before}}})?")
        if before <= 5:
            alts.append(f"{pre}::({_HEX}:){{0,{5 - before}}}{_V4}")
    return alts


# Surrounding blanks are ignored, as the validators strip before parsing.
_WS = r"[ \t\n\r\f\v]*"
IP_PATTERN = f"^{_WS}({_V4}|(" + "|".join(_ipv6_alternatives()) + f")(%[^%]+)?){_WS}$"
# Re-exported for the leak scan.
DOTTED_QUAD_PATTERN = K.DOTTED_QUAD_PATTERN


def is_valid_ip(c: Column) -> Column:
    """True for a valid IPv4/IPv6 literal; False for null, blank or junk."""
    return F.coalesce(c.rlike(IP_PATTERN), F.lit(False))


def octets(c: Column) -> Column:
    """First two octets as integers (NULL if not numeric) and the number of parts of an address."""
    dots = F.length(c) - F.length(F.replace(c, F.lit("."), F.lit("")))
    second = F.when(c.contains("."), F.substring_index(F.substring_index(c, ".", 2), ".", -1))
    return F.struct(F.substring_index(c, ".", 1).try_cast("int").alias("a"), second.try_cast("int").alias("b"),
                    (dots + 1).alias("n"))


def is_internal(o: Column) -> Column:
    """Private/loopback/link-local IPv4 test of the relevance cascade, on bound ``octets``.

    Missing, non-4-part (so every IPv6) and non-numeric leading octets count
    as internal; multicast and broadcast count as external.
    """
    a, b = o["a"], o["b"]
    private = ((a == 10) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168)) | (a == 127)
               | ((a == 169) & (b == 254)))
    return a.isNull() | b.isNull() | (o["n"] != 4) | private
