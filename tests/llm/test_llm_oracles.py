"""Queries against their DuckDB statements: on the tables, and on odd rows written as tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import compare, duck  # noqa: E402
from test_conversations import SCHEMA, TALK  # noqa: E402

from wiretable.llm.registry import ORACLES, QUERIES  # noqa: E402

SF01 = "/root/testdata/sf0.01"
SF001 = "/root/testdata/sf0.001"


def agrees(spark, folder, name):
    r = compare(QUERIES[name](spark, folder), duck(folder), ORACLES[name])
    assert r["rows_spark"] == r["rows_oracle"] and r["columns_match"] and r["values_match"], r


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    agrees(spark, SF01, name)


@pytest.fixture(scope="module")
def odd_folder(spark, odd_rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    for table in os.listdir(SF001):
        if table.split(".")[0] not in ("documents", "conversations", "benchmark"):
            os.symlink(f"{SF001}/{table}", f"{folder}/{table}")
    single = {i: t for i, t in odd_rows}  # the statements join on doc_id
    docs = [(i, t, ["en", "fr", None][i % 3], "s", None) for i, t in single.items()]
    items = [(1, "one two THREE alpha"), (2, None), (3, "!!"), (4, "x " * 12), (5, "été")]
    for name, rows, schema in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
                               ("benchmark", items, "item_id long, text string"), ("conversations", TALK, SCHEMA)):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")
        part = next(f for f in os.listdir(f"{folder}/{name}") if f.endswith(".parquet"))
        os.symlink(f"{folder}/{name}/{part}", f"{folder}/{name}.parquet")
    return folder


def test_items_without_an_id_match_oracle(spark, odd_folder, tmp_path):
    for table in os.listdir(odd_folder):
        if table != "benchmark.parquet" and table.endswith(".parquet"):
            os.symlink(os.path.realpath(f"{odd_folder}/{table}"), f"{tmp_path}/{table}")
    items = [(1, "one two THREE alpha"), (None, "delta one"), (None, "x x x"), (None, None), (5, "été")]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark")
    part = next(f for f in os.listdir(f"{tmp_path}/benchmark") if f.endswith(".parquet"))
    os.symlink(f"{tmp_path}/benchmark/{part}", f"{tmp_path}/benchmark.parquet")
    agrees(spark, str(tmp_path), "op8_decontaminate")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_odd_rows_match_oracle(spark, odd_folder, name):
    agrees(spark, odd_folder, name)
