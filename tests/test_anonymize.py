"""Validation checks of a pseudonymised table: they pass on a good one and fail on a damaged one."""

import pytest
from pyspark.sql import functions as F

from wiretable.functions import constants as K
from wiretable.operators.anonymize import hash_metrics, pseudonym_checks, pseudonymize

COLUMNS = "packet_id long, timestamp string, src_ip string, dst_ip string, protocol string, length int"
ROWS = [(1, "t", "10.0.2.15", "192.168.1.1", "TCP", 1), (2, "t", "10.0.2.15", "8.8.8.8", "UDP", None),
        (3, "t", None, "93.184.216.34", "TCP", 3), (4, "u", "10.0.2.15", "192.168.1.1", "TCP", 4)]


def failed(before, after, prof):
    return {r.check for r in pseudonym_checks(before, after, prof).collect() if not r.passed}


@pytest.mark.parametrize("prof", ["integrated", "modular"])
def test_checks(spark, prof):
    before = spark.createDataFrame(ROWS, COLUMNS)
    after = pseudonymize(before, prof, K.PUBLISHED_SALT)
    src, dst = ("src_ip_anonimizada", "dst_ip_anonimizada") if prof == "integrated" else ("src_ip_anon", "dst_ip_anon")

    def damaged(column, value, where="packet_id = 1"):
        return after.withColumn(column, F.when(F.expr(where), value).otherwise(F.col(column)))

    assert failed(before, after, prof) == set()
    assert "row_count_preserved" in failed(before, after.where("packet_id > 1"), prof)
    assert {"no_address_leak", "hash_format_src"} <= failed(before, damaged(src, F.lit("10.0.2.15")), prof)
    assert "hash_format_dst" in failed(before, damaged(dst, F.lit("XYZ")), prof)
    assert {"relation_preserved", "known_vectors"} <= failed(before, damaged(src, F.lit("0123456789abcdef")), prof)
    assert "no_pair_collision" in failed(before, after.withColumn(src, F.lit("0123456789abcdef")).withColumn(dst, F.lit("0123456789abcdef")), prof)
    assert "src_completeness" in failed(before, damaged(src, F.lit(None).cast("string")), prof)
    assert "unique_dst_preserved" in failed(before, after.withColumn(dst, F.lit("0123456789abcdef")), prof)
    assert "intact_length" in failed(before, damaged("length", F.lit(None).cast("int")), prof)
    assert "known_vectors" in failed(before, pseudonymize(before, prof, "another salt"), prof)
    m = hash_metrics(after, prof).first()
    assert (m.rows_processed, m.hashes, m.unique_hashes, m.missing_addresses) == (4, 7, 4, 1)
