"""Pseudonymisation (N1) and its validation.

Addresses are replaced by the first 16 hex characters of a salted SHA-256,
computed natively (``sha2``) and stateless per row, so no memo table is
needed.  With a known salt the IPv4 space can be enumerated: this is
pseudonymisation, not anonymisation, and the salt is a required argument.

Checks run as single aggregations over *all* rows, never samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import fields as X
from ..functions.addresses import DOTTED_QUAD_PATTERN
from ..schema import Profile, profile as _profile
from ..session import materialize

HASH_FORMAT = K.HASH_FORMAT_PATTERN


def pseudonymize(df: DataFrame, prof: str | Profile, salt: str,
                 keep_raw: bool = False) -> DataFrame:
    """Adds the profile's pseudonym columns and drops the raw addresses.

    ``integrated`` appends the two columns last; ``modular`` puts them where
    the addresses were.
    """
    prof = _profile(prof)
    if not salt:
        raise ValueError("a salt is required")
    src_anon, dst_anon = prof.anon_columns
    h = lambda c: X.pseudonym(F.col(c), salt, prof.hash_salt_first, prof.hash_missing_as_empty)
    cols = []
    for c in df.columns:
        if c == "src_ip":
            if keep_raw:
                cols.append(F.col(c))
            if not prof.hash_missing_as_empty:
                cols.append(h("src_ip").alias(src_anon))
        elif c == "dst_ip":
            if keep_raw:
                cols.append(F.col(c))
            if not prof.hash_missing_as_empty:
                cols.append(h("dst_ip").alias(dst_anon))
        else:
            cols.append(F.col(c))
    if prof.hash_missing_as_empty:
        cols += [h("src_ip").alias(src_anon), h("dst_ip").alias(dst_anon)]
    return df.select(*cols)


def pseudonym_checks(before: DataFrame, after: DataFrame, prof: str | Profile,
                     key: str = "packet_id", known: dict[str, str] | None = None) -> DataFrame:
    """All validation checks as one metrics table: (check, expected, actual, passed).

    ``before`` holds raw addresses and ``after`` the pseudonyms, two stored
    tables that carry ``key``, so rows align by identity, not position.  The
    published vectors (``known``: address -> pseudonym) are literal values; they
    hold for the published salt only, so pass an empty dict for another one.
    Distribution figures are metrics, not checks: see ``hash_metrics``.
    """
    prof = _profile(prof)
    sa, da = prof.anon_columns
    if known is None:
        known = K.GOLDEN_SALT_FIRST if prof.hash_salt_first else K.GOLDEN_SALT_LAST
    b = before.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("src_ip").alias("src"), F.count_distinct("dst_ip").alias("dst"),
        F.count(F.nullif("src_ip", F.lit(""))).alias("src_nn"),
        F.count(F.nullif("dst_ip", F.lit(""))).alias("dst_nn"),
        *[F.count(c).alias(f"nn_{c}") for c in _analytic(before)],
    )
    a = after.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.nullif(F.col(sa), F.lit(""))).alias("src"),
        F.count_distinct(F.nullif(F.col(da), F.lit(""))).alias("dst"),
        F.count(F.nullif(F.col(sa), F.lit(""))).alias("src_nn"),
        F.count(F.nullif(F.col(da), F.lit(""))).alias("dst_nn"),
        F.count_if(~F.coalesce(F.col(sa).rlike(HASH_FORMAT), F.lit(False))
                   & ~X.is_missing(F.col(sa))).alias("bad_src_format"),
        F.count_if(~F.coalesce(F.col(da).rlike(HASH_FORMAT), F.lit(False))
                   & ~X.is_missing(F.col(da))).alias("bad_dst_format"),
        F.count_if(F.coalesce(F.col(sa).rlike(DOTTED_QUAD_PATTERN), F.lit(False))
                   | F.coalesce(F.col(da).rlike(DOTTED_QUAD_PATTERN), F.lit(False))).alias("leaks"),
        *[F.count(c).alias(f"nn_{c}") for c in _analytic(after)],
    )
    # One join of both tables, reduced to its distinct address pairs: few rows against the
    # input, stored once for the three checks that read it.
    pairs = materialize(before.select(key, "src_ip", "dst_ip").join(after.select(key, sa, da), key)
                        .groupBy("src_ip", "dst_ip", sa, da).agg(F.count(F.lit(1)).alias("n")))
    rel = pairs.groupBy("src_ip", "dst_ip").agg(F.count(F.lit(1)).alias("images")) \
        .agg(F.count_if(F.col("images") != 1).alias("broken"))
    inverse = pairs.groupBy(sa, da).agg(F.count(F.lit(1)).alias("pre")) \
        .agg(F.count_if(F.col("pre") != 1).alias("collisions"))
    wanted = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else None

    def wrong(ip: str, pseudonym: str):
        want = F.element_at(wanted, F.coalesce(F.col(ip), F.lit("")))
        return F.when(want.isNotNull() & ~F.col(pseudonym).eqNullSafe(want), F.col("n")).otherwise(0)

    bad = wrong("src_ip", sa) + wrong("dst_ip", da) if known else F.lit(0)
    seen = pairs.agg(F.coalesce(F.sum(bad), F.lit(0)).alias("known_bad"))

    # Every aggregate is one row; melt them into (metric, value) and pair up.
    metrics = None
    for prefix, agg in (("b_", b), ("a_", a), ("", rel), ("", inverse), ("", seen)):
        part = agg.select(F.explode(F.array(*[
            F.struct(F.lit(prefix + c).alias("metric"), F.col(c).cast("long").alias("value"))
            for c in agg.columns])).alias("m")).select("m.*")
        metrics = part if metrics is None else metrics.unionByName(part)
    analytic = _analytic(before)
    pairs_of = [
        ("row_count_preserved", "b_rows", "a_rows"),
        ("unique_src_preserved", "b_src", "a_src"),
        ("unique_dst_preserved", "b_dst", "a_dst"),
        ("src_completeness", "b_src_nn", "a_src_nn"),
        ("dst_completeness", "b_dst_nn", "a_dst_nn"),
        *[(f"intact_{c}", f"b_nn_{c}", f"a_nn_{c}") for c in analytic],
        ("hash_format_src", None, "a_bad_src_format"),
        ("hash_format_dst", None, "a_bad_dst_format"),
        ("no_address_leak", None, "a_leaks"),
        ("relation_preserved", None, "broken"),
        ("no_pair_collision", None, "collisions"),
        ("known_vectors", None, "known_bad"),
    ]
    val = lambda m: F.max(F.when(F.col("metric") == m, F.col("value")))
    wide = metrics.agg(*[F.struct(F.lit(n).alias("check"),
                                  (val(e) if e else F.lit(0).cast("long")).alias("expected"),
                                  val(v).alias("actual")).alias(n) for n, e, v in pairs_of])
    out = wide.select(F.explode(F.array(*[F.col(n) for n, _, _ in pairs_of])).alias("c")).select("c.*")
    return out.withColumn("passed", F.col("expected") == F.col("actual"))


def hash_metrics(after: DataFrame, prof: str | Profile) -> DataFrame:
    """Figures of a pseudonymised table (N11): rows, hashes, distinct hashes, missing addresses."""
    prof = _profile(prof)
    both = F.array(*[F.nullif(F.col(c), F.lit("")) for c in prof.anon_columns])
    return after.select(F.explode(both).alias("h")).agg(
        (F.count(F.lit(1)) / 2).cast("bigint").alias("rows_processed"), F.count("h").alias("hashes"),
        F.count_distinct("h").alias("unique_hashes"), F.count_if(F.col("h").isNull()).alias("missing_addresses"))


def _analytic(df: DataFrame) -> list[str]:
    wanted = ["timestamp", "protocol", "src_port", "dst_port", "length", "dns_query",
              "http_host", "http_path", "user_agent"]
    return [c for c in wanted if c in df.columns]
