"""Generated code: methods that the JVM compiles, and the cheap forms of field rules."""

import random

from compare import SF001
from pyspark.sql import functions as F
from wiretable.functions import addresses as A
from wiretable.functions import fields as X
from wiretable.operators.quality import with_reject_reason
from wiretable.plans.pipeline import extract
from wiretable.plans.registry import raw_export
from wiretable.schema import INTEGRATED, MODULAR

#: HotSpot interprets methods of more bytes for ever.
COMPILED_BYTES = 8000


def _largest_method(spark, df):
    plan = df._jdf.queryExecution().executedPlan()
    codes = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package").codegenStringSeq(plan)
    assert codes.size() > 0
    return max(codes.apply(k)._3().maxMethodCodeSize() for k in range(codes.size()))


def test_extraction_and_validation_make_methods_that_are_compiled(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for prof in (MODULAR, INTEGRATED):
            extracted = extract(raw_export(spark, SF001), prof).extracted
            assert _largest_method(spark, with_reject_reason(extracted, prof)) <= COMPILED_BYTES
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_quotes_and_repeated_values(spark):
    texts = [None, "", '"', '""a"b""', 'a"\n', "a,b", ",b", ",", "a", 'ü",ß', "\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = df.select(F.regexp_replace("t", '^"+|"+$', "").alias("q"), F.get(F.split("t", ","), 0).alias("f")).collect()
    assert df.select(X.strip_quotes(F.col("t")).alias("q"), X.first_occurrence(F.col("t")).alias("f")).collect() == plain


def test_addresses_are_not_split_and_patterns_have_cheap_guards(spark):
    df = spark.createDataFrame([("10.0.2.3",)], "t string")
    plan = lambda c: df.select(c)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan(A.octets(F.col("t")))
    assert "Contains(" in plan(X.squash_blanks(F.col("t")))
    checked = with_reject_reason(extract(raw_export(spark, SF001), MODULAR).extracted, MODULAR)
    patterns = checked._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE /" not in patterns and "RLIKE ," not in patterns


def test_octets_integers_and_blanks_match_their_patterns(spark):
    rng = random.Random(11)
    signs = [*"0123456789.:+-Zz \t\n\r\u000b\f\u0001\u0085,", "  ", "..", "10.0.2.3", "172.16", ":11", "+02:00", "9" * 20]
    texts = [None, "", ".", "..", "007", "+7", " 7 ", "7\n", "-0", "\u00017", "7.0", "9" * 25, "1.2.3.4.", "10:11Z", "10:11 +02:00"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c, parts = F.col("t"), F.split("t", "[.]")
    plain = df.select(
        F.struct(F.get(parts, 0).try_cast("int").alias("a"), F.get(parts, 1).try_cast("int").alias("b"), F.size(parts).alias("n")),
        F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.coalesce(F.trim(c).try_cast("bigint"), F.lit(-1).cast("bigint"))),
        F.trim(F.regexp_replace(F.regexp_replace(c, r"\s+", " "), X.ZONE_OFFSET_PATTERN, "$1")))
    got = df.select(A.octets(c), X.integer_text_value(c), X.squash_blanks(c))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in plain.collect()]
