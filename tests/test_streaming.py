"""Incremental ingest: files arriving in two rounds are each processed once."""

import os

from test_sources_tables import _write
from wiretable.schema import RAW16_FIELDS
from wiretable.streaming.ingest import ingest_exports


def test_ingest_two_rounds(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    t = "May 17, 2023 10:44:38.201312000 CEST"
    row = [t, "10.0.2.15", "", "8.8.8.8", "", "6", "", "1234", "80", "", "", "60", "", "", "", ""]
    bad = [t, "", "", "8.8.8.8", "", "6", "", "1234", "80", "", "", "60", "", "", "", ""]
    _write(os.path.join(src, "a.tsv"), "\t", RAW16_FIELDS, [row, bad])
    sink, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    ingest_exports(spark, src, "integrated", sink, ckpt, glob="*.tsv").awaitTermination(120)
    _write(os.path.join(src, "b.tsv"), "\t", RAW16_FIELDS, [row, row])
    ingest_exports(spark, src, "integrated", sink, ckpt, glob="*.tsv").awaitTermination(120)
    kept = spark.read.parquet(f"{sink}/extracted")
    outcomes = spark.read.parquet(f"{sink}/outcomes")
    assert kept.count() == 3
    assert sorted(r.source_file for r in kept.select("source_file").distinct().collect()) == ["a.tsv", "b.tsv"]
    assert {r.extract_outcome for r in outcomes.collect()} == {"kept", "missing_address_or_time"}


def test_ingest_quoted_csv_modular(spark, scratch):
    from wiretable.schema import RAW13_FIELDS
    src = os.path.join(scratch, "in13")
    os.makedirs(src)
    t = "May 17, 2023 10:44:38.201312000 CEST"
    rows = [[t, "10.0.2.15", "8.8.8.8", "6", "1234", "443", "", "", "60", "", "", "", ""],
            [t, "10.0.0.1", "10.0.0.2", "17", "", "", "1000", "2000", "", "", "", "", ""],
            [t, "10.0.2.15", "8.8.8.8", "6", "1234"]]                    # short row
    _write(os.path.join(src, "c.csv"), ",", RAW13_FIELDS, rows, quote=True)
    sink, ckpt = os.path.join(scratch, "out13"), os.path.join(scratch, "ckpt13")
    ingest_exports(spark, src, "modular", sink, ckpt, glob="*.csv").awaitTermination(120)
    outcomes = sorted(r.extract_outcome for r in spark.read.parquet(f"{sink}/outcomes").collect())
    assert outcomes == ["kept", "rule_9", "short_row"]
    kept = spark.read.parquet(f"{sink}/extracted").collect()
    assert [(r.src_ip, r.protocol, r.dst_port) for r in kept] == [("10.0.2.15", "TCP", "443")]


def test_a_batch_that_runs_again_adds_no_rows(spark, scratch):
    src, sink = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(src)
    t = "May 17, 2023 10:44:38.201312000 CEST"
    row = [t, "10.0.2.15", "", "8.8.8.8", "", "6", "", "1234", "80", "", "", "60", "", "", "", ""]
    _write(os.path.join(src, "a.tsv"), "\t", RAW16_FIELDS, [row, row])
    # Two streams with fresh checkpoints both run the files as batch 0.
    for k in range(2):
        ingest_exports(spark, src, "integrated", sink, os.path.join(scratch, f"ckpt{k}"), glob="*.tsv").awaitTermination(120)
    assert spark.read.parquet(f"{sink}/extracted").count() == 2
    assert spark.read.parquet(f"{sink}/outcomes").count() == 2
