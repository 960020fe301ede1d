"""Indicator matching: the most specific address block or domain that a value lies in.

An address is a string of its bits, so a block is a prefix: ``family:bits``.  Each
distinct address is tried at the prefix lengths that the indicators have (at most
161), each distinct name at its suffixes, both joined by equality; the longest match
is joined back to the rows.  Address ranges are cut at prefix boundaries first (at
most two blocks of a size).  Nothing is compared by range in the join, so there is no
nested loop, and a hot address is one row of the lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import bounded_join
from ..functions.addresses import is_valid_ip
from ..session import bind, materialize

V4_BITS, V6_BITS = 32, 128


def _bits(number: Column, size: int) -> Column:
    return F.lpad(F.bin(number), size, "0")


def _v4_number(text: Column) -> Column:
    parts = F.split(text, "[.]")
    number = F.lit(0).cast("bigint")
    for k in range(4):
        number = number * 256 + F.get(parts, F.lit(k)).cast("bigint")
    return number


#: Matches are broadcast to the packets only below this many.
BROADCAST_ROWS = 1_000_000
#: An IPv4 address at the end of an IPv6 address.
EMBEDDED_QUAD = r"([0-9]+[.][0-9.]+)$"


def _v6_bits(text: Column, quad: Column) -> Column:
    """Eight groups of 16 bits; ``::`` stands for the missing ones, an embedded quad for two."""
    def groups(part: Column) -> Column:
        return F.filter(F.split(part, ":"), lambda g: g != "")

    number = _v4_number(quad)
    tail = F.concat(F.hex(F.shiftright(number, 16)), F.lit(":"), F.hex(number.bitwiseAND(0xFFFF)))
    plain = F.when(quad != "", F.concat(F.left(text, F.length(text) - F.length(quad)), tail)).otherwise(text)
    rest = F.when(F.contains(plain, F.lit("::")), F.substring_index(plain, "::", -1)).otherwise("")
    left, right = groups(F.substring_index(plain, "::", 1)), groups(rest)
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(F.transform(F.concat(left, zeros, right), lambda g: _bits(F.conv(g, 16, 10).cast("bigint"), 16)), "")


def with_address_bits(df: DataFrame, column: str, name: str = "bits") -> DataFrame:
    """Adds the address as ``4:`` or ``6:`` and its bits; null where the text is no address (a zone is left out)."""
    text = F.substring_index(F.trim(F.col(column)), "%", 1)
    df = bind(df, _text=text, _quad=F.regexp_extract(text, EMBEDDED_QUAD, 1))
    text, quad = F.col("_text"), F.col("_quad")
    v4 = F.concat(F.lit("4:"), _bits(_v4_number(text), V4_BITS))
    bits = F.when(F.contains(text, F.lit(":")), F.concat(F.lit("6:"), _v6_bits(text, quad))).otherwise(v4)
    return bind(df, **{name: F.when(is_valid_ip(text), bits)}).drop("_text", "_quad")


def range_blocks(low: Column, high: Column) -> Column:
    """The aligned blocks (start, size) that an IPv4 range of numbers is cut into, at most two of a size."""
    none = F.array().cast("array<bigint>")

    def of_size(size: Column) -> Column:
        width = F.pow(F.lit(2), V4_BITS - size).cast("bigint")

        def inside(w: Column) -> tuple[Column, Column]:
            """Begin and end of the aligned blocks of a width that lie in the range."""
            return F.ceil(low / w).cast("bigint") * w, F.floor((high + 1) / w).cast("bigint") * w

        begin, end = inside(width)
        wide_begin, wide_end = inside(2 * width)
        # Next to what wider blocks cover there is at most one at each side; without wider blocks at most two.
        edges = F.concat(F.when(begin < wide_begin, F.array(begin)).otherwise(none),
                         F.when(wide_end < end, F.array(end - width)).otherwise(none))
        own = F.when(begin >= end, none).when(wide_begin < wide_end, edges).otherwise(
            F.array_distinct(F.array(begin, end - width)))
        return F.transform(own, lambda x: F.struct(x.alias("start"), size.alias("size")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(V4_BITS)), of_size))


def address_prefixes(indicators: DataFrame) -> DataFrame:
    """indicator, prefix: blocks ``address/size``, single addresses, and IPv4 ranges ``low-high``."""
    rows = indicators.select(F.trim("indicator").alias("indicator"))
    span = rows.where(F.contains("indicator", F.lit("-")))
    low, high = F.split("indicator", "-")[0], F.split("indicator", "-")[1]
    span = with_address_bits(with_address_bits(span.withColumns({"low": low, "high": high}), "low", "lb"), "high", "hb")
    span = span.where("lb like '4:%' and hb like '4:%' and lb <= hb").select(
        "indicator", F.inline(range_blocks(F.conv(F.substring("lb", 3, 32), 2, 10).cast("bigint"),
                                           F.conv(F.substring("hb", 3, 32), 2, 10).cast("bigint"))))
    span = span.select("indicator", F.concat(F.lit("4:"), F.left(_bits(F.col("start"), V4_BITS), F.col("size"))).alias("prefix"))
    block = with_address_bits(rows.where(~F.contains("indicator", F.lit("-"))).withColumn(
        "address", F.substring_index("indicator", "/", 1)), "address")
    size = F.when(F.contains("indicator", F.lit("/")), F.substring_index("indicator", "/", -1).try_cast("int")).otherwise(F.length("bits") - 2)
    block = block.withColumn("size", size).where("bits is not null and size between 0 and length(bits) - 2")
    return span.unionByName(block.select("indicator", F.left("bits", F.col("size") + 2).alias("prefix"))).distinct()


def match_addresses(values: DataFrame, indicators: DataFrame) -> DataFrame:
    """address, indicator: the longest block of each distinct address of column ``address`` (ties: least text)."""
    prefixes = materialize(address_prefixes(indicators))
    # At most 33 + 129 lengths: a bounded list, whatever the number of indicators.
    lengths = sorted(r[0] for r in prefixes.select(F.length("prefix")).distinct().collect())
    distinct = with_address_bits(values.select("address").where("address is not null").distinct(), "address").where("bits is not null")
    tried = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("bits"))
    keys = distinct.select("address", F.explode(F.transform(tried, lambda n: F.left("bits", n))).alias("prefix"))
    found = bounded_join(keys, prefixes, "prefix", "inner", BROADCAST_ROWS)
    best = F.min(F.struct((-F.length("prefix")).alias("m"), F.col("indicator")))
    return found.groupBy("address").agg(best.alias("best")).select("address", F.col("best.indicator").alias("indicator"))


def match_domains(values: DataFrame, indicators: DataFrame) -> DataFrame:
    """name, indicator: the longest domain that each distinct name of column ``name`` is or lies in (case is ignored)."""
    domains = indicators.select("indicator", F.lower(F.rtrim(F.col("indicator"), F.lit("."))).alias("suffix")).where("suffix != ''").distinct()
    labels = F.split(F.lower(F.rtrim(F.col("name"), F.lit("."))), "[.]")
    names = values.select("name").where("name is not null").distinct()
    keys = bind(names, labels=labels).select("name", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("labels")), lambda k: F.array_join(F.slice(F.col("labels"), k, F.size("labels")), "."))).alias("suffix"))
    found = bounded_join(keys, domains, "suffix", "inner", BROADCAST_ROWS)
    best = F.min(F.struct((-F.length("suffix")).alias("m"), F.col("indicator")))
    return found.groupBy("name").agg(best.alias("best")).select("name", F.col("best.indicator").alias("indicator"))


def indicator_match(packets: DataFrame, indicators: DataFrame, id_col: str = "packet_id") -> DataFrame:
    """Packets with a match: id, src_indicator, dst_indicator, dns_indicator (null where that field matches none).

    ``indicators`` has ``kind`` (address or domain) and ``indicator``.
    """
    blocks = indicators.where("kind = 'address'").select("indicator")
    domains = indicators.where("kind = 'domain'").select("indicator")
    ends = packets.select(F.col("src_ip").alias("address")).unionByName(packets.select(F.col("dst_ip").alias("address")))
    addresses = materialize(match_addresses(ends, blocks))
    names = materialize(match_domains(packets.select(F.col("dns_query").alias("name")), domains))
    out = packets.select(id_col, "src_ip", "dst_ip", "dns_query")
    for column, found, key in (("src_ip", addresses, "address"), ("dst_ip", addresses, "address"), ("dns_query", names, "name")):
        own = found.select(F.col(key).alias(column), F.col("indicator").alias(f"{column.split('_')[0]}_indicator"))
        out = bounded_join(out, own, column, "left", BROADCAST_ROWS)
    columns = ["src_indicator", "dst_indicator", "dns_indicator"]
    return out.where(" or ".join(f"{c} is not null" for c in columns)).select(id_col, *columns)
