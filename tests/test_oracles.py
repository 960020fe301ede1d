"""Registered queries vs their DuckDB oracles at sf0.01 (the correctness gate)."""

import pytest

from compare import compare, duck
from compare import SF01
from wiretable.plans.oracles import oracles
from wiretable.plans.registry import QUERIES

@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracles())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF01), con, oracles()[name])
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["columns_match"], r
    assert r["values_match"], r


def test_golden_counts(spark):
    from collections import Counter
    rej = Counter(r.reason for r in QUERIES["reject_reasons_integrated"](spark, SF01).collect())
    assert rej == {"missing_required": 106, "invalid_ip": 110, "invalid_port": 102,
                   "invalid_timestamp": 96, "ok": 10586}
    rel = Counter(r.relevance_rule for r in QUERIES["relevance_rules"](spark, SF01).collect())
    assert rel == {1: 106, 3: 1009, 4: 2272, 5: 266, 6: 1149, 7: 3413, 8: 1269, 9: 1516}
    assert QUERIES["flow_thin_60s"](spark, SF01).count() == 7994
    assert QUERIES["flow_thin_1s"](spark, SF01).count() == 9957
    ends = QUERIES["distinct_endpoints"](spark, SF01).first()
    assert (ends.distinct_src, ends.distinct_dst) == (152, 23)


def test_pseudonym_checks_pass(spark):
    rows = {r.check: r for r in QUERIES["pseudonym_checks"](spark, SF01).collect()}
    assert all(r.passed for r in rows.values()), rows
    assert rows["row_count_preserved"].expected == 11000 - 106   # the extraction drops rows without an address


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", ["relevance_rules", "ip_leak_scan", "completeness", "extraction_stats",
                                  "q5_length_stats", "q6_protocol_share", "pseudonym_checks"])
def test_column_types_match_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    rel = con.sql(oracles()[name])
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
