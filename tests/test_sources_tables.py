"""Export readers (tab and quoted CSV), extraction statistics, table load."""

import os

import pytest
from pyspark.sql import functions as F

from wiretable.operators.profiling import extraction_stats, file_outcomes
from wiretable.plans.pipeline import extract, run
from wiretable.plans.tables import describe_table, load_checks, write_load, write_table
from wiretable.schema import RAW13_FIELDS, RAW16_FIELDS
from wiretable.sources.exports import list_exports, read_export


def _write(path, sep, header, rows, quote=False):
    with open(path, "w") as fh:
        fh.write(sep.join(header) + "\n")
        for r in rows:
            vals = [f'"{v}"' if quote else v for v in r]
            fh.write(sep.join(vals) + "\n")


def test_tab_export_integrated(spark, scratch):
    t = "May 17, 2023 10:44:38.201312000 CEST"
    rows = [
        [t, "10.0.2.15", "", "8.8.8.8", "", "17", "", "", "", "5353", "53", "74", "a.example", "", "", ""],
        [t, "", "fe80::1", "", "fe80::2", "", "58", "", "", "", "", "90", "", "", "", ""],
        [t, "", "", "8.8.8.8", "", "6", "", "1234", "80", "", "", "60", "", "h", "/", "ua"],
        [t, "10.0.2.15", "", "8.8.8.8", "", "6"],                      # short row: padded
    ]
    _write(os.path.join(scratch, "a.tsv"), "\t", RAW16_FIELDS, rows)
    raw = read_export(spark, scratch, "integrated", glob="*.tsv")
    ex = extract(raw, "integrated")
    got = sorted(ex.extracted.select("src_ip", "protocol", "src_port", "dst_port").collect(),
                 key=lambda r: (r.protocol, r.src_ip))
    assert [(r.src_ip, r.protocol, r.src_port, r.dst_port) for r in got] == [
        ("fe80::1", "ICMPv6", None, None), ("10.0.2.15", "TCP", None, None),
        ("10.0.2.15", "UDP", "5353", "53")]
    stats = {r.source_file: r for r in extraction_stats(ex.tagged).collect()}
    assert stats["__all__"].total == 4 and stats["__all__"].kept == 3
    assert list_exports(spark, scratch, "*.tsv").count() == 1
    with pytest.raises(FileNotFoundError):
        list_exports(spark, scratch, "*.pcapng")
    outcomes = file_outcomes(list_exports(spark, scratch, "*.tsv"), ex.tagged).collect()
    assert [r.outcome for r in outcomes] == ["processed"]
    # Whole pipeline on the export: the ICMPv6, UDP and padded TCP rows survive.
    result = run(raw, "integrated", salt="s3cret")
    anon = result.anonymised.collect()
    assert len(anon) == 3
    assert all(len(r.src_ip_anonimizada) == 16 for r in anon)
    assert "src_ip" not in result.anonymised.columns


def test_quoted_csv_export_modular(spark, scratch):
    t = "May 17, 2023 10:44:38.201312000 CEST"
    rows = [
        [t, "10.0.2.15,10.0.2.16", "8.8.8.8", "6", "1234", "443", "", "", "60", "", "", "", ""],
        [t, "10.0.0.1", "10.0.0.2", "17", "", "", "1000", "2000", "", "", "", "", ""],
        [t, "10.0.0.1", "10.0.0.2", "47", "", "", "", "", "70", "", "", "", ""],
        [t, "10.0.0.1", "8.8.8.8", "6", "1234", "443"],                 # short row
    ]
    _write(os.path.join(scratch, "b.csv"), ",", RAW13_FIELDS, rows, quote=True)
    raw = read_export(spark, scratch, "modular", glob="*.csv")
    ex = extract(raw, "modular")
    kept = ex.extracted.collect()
    assert len(kept) == 1
    r = kept[0]
    assert (r.src_ip, r.protocol, r.src_port, r.dst_port, r.length) == ("10.0.2.15", "TCP", "1234", "443", "60")
    outcomes = sorted(r.extract_outcome for r in ex.tagged.collect())
    assert outcomes == ["kept", "rule_9", "rule_9", "short_row"]


EXPORT = "frame.time,ip.src,ip.dst,ip.proto,tcp.srcport,tcp.dstport,udp.srcport,udp.dstport,frame.len,dns.qry.name,http.host,http.request.uri,http.user_agent"


def test_export_rows_as_a_csv_reader_splits_them(spark, scratch):
    """Bare empties, doubled quotes, a backslash before a quote, 12, 13 and 14 fields."""
    lines = [
        "t,10.0.0.1,8.8.8.8,6,1,2,,,60,,,,",
        '"t","10.0.0.1","8.8.8.8","6","1","2",,,"60",,,,',
        "t,10.0.0.1,8.8.8.8,6,1,2,,,60,,,",
        't,10.0.0.1,8.8.8.8,6,1,2,,,60,,"h","/c:\\","ua2"',
        't,10.0.0.1,8.8.8.8,6,1,2,,,60,,,,"ag ""q"" x"',
        "t,10.0.0.1,8.8.8.8,6,1,2,,,60,,,/p,ua,extra,more",
        '"a, b",10.0.0.1,8.8.8.8,6,1,2,,,60,,,,""',
        'x,"1,2,3,4,5,6,7,8,9,10,11,12,13"',
    ]
    with open(os.path.join(scratch, "x y+z%1.csv"), "w") as fh:
        fh.write("\n".join([EXPORT, *lines]) + "\n")
    rows = read_export(spark, scratch, "modular", glob="*.csv").collect()
    assert [r.short_row for r in rows] == [False, False, True, False, False, False, False, True]
    assert rows[3]["http.request.uri"] == "/c:\\" and rows[3]["http.user_agent"] == "ua2"
    assert rows[4]["http.user_agent"] == 'ag "q" x' and rows[5]["http.user_agent"] == "ua"
    assert rows[6]["frame.time"] == "a, b"
    assert {r.source_file for r in rows} == {"x y+z%1.csv"}
    listing = list_exports(spark, scratch, "*.csv")
    assert [r.source_file for r in listing.collect()] == ["x y+z%1.csv"]


def test_long_quoted_fields_of_short_rows(spark, scratch):
    """A short row with a field of a megabyte, one of doubled quotes and one that never closes."""
    long = 1 << 20
    lines = ['t,"' + "x," * (long // 2) + '"', 't,"' + '""' * (long // 2) + '",1', 't,"' + "y" * long, "t,10.0.0.1,8.8.8.8,6,1,2,,,60,,,,ua"]
    with open(os.path.join(scratch, "long.csv"), "w") as fh:
        fh.write("\n".join([EXPORT, *reversed(lines)]) + "\n")
    read = read_export(spark, scratch, "modular", glob="*.csv")
    # Only the counts are asked for: no other column is read.
    r = read.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"), F.count_if("short_row").alias("short")).first()
    assert (r.source_file, r.rows, r.short) == ("long.csv", 4, 3)


def test_file_outcomes(spark, scratch):
    for name, body in (("full one.csv", "t,10.0.0.1,8.8.8.8,6,1,2,,,60,,,,\n"), ("empty.csv", "")):
        with open(os.path.join(scratch, name), "w") as fh:
            fh.write(EXPORT + "\n" + body)
    tagged = extract(read_export(spark, scratch, "modular", glob="*.csv"), "modular").tagged
    failed = spark.createDataFrame([("broken.pcapng",)], "source_file string")
    got = {r.source_file: r.outcome for r in file_outcomes(list_exports(spark, scratch, "*.csv"), tagged, failed).collect()}
    assert got == {"full one.csv": "processed", "empty.csv": "no_data", "broken.pcapng": "failed"}


def test_missing_tokens_and_edges_by_profile(spark):
    raw = spark.createDataFrame([(1, "f", "May 17, 2023 10:44:38", '"10.0.2.15"', "8.8.8.8", "6", "1", "443", "", "", "60",
                                  "NA", " h ", "null", '"agent"')],
                                "packet_id long, source_file string, " + ", ".join(f"`{f}` string" for f in RAW13_FIELDS))
    r = extract(raw, "modular", na=("NA", "null")).tagged.first()
    assert (r.src_ip, r.dns_query, r.http_host, r.http_path, r.user_agent) == ("10.0.2.15", None, " h ", None, "agent")
    wide = raw.select("*", *[F.lit("").alias(f) for f in RAW16_FIELDS if f not in RAW13_FIELDS])
    r = extract(wide, "integrated").tagged.first()
    assert (r.src_ip, r.dns_query, r.http_host, r.user_agent) == ('"10.0.2.15"', "NA", "h", '"agent"')


LOADED = ("packet_id long, timestamp string, protocol string, src_ip_anon string, dst_ip_anon string, dns_query string, "
          "length int, event_time timestamp")


def _traffic(spark, rows):
    return spark.createDataFrame([(i, t, "TCP", "a", d, None, n) for i, (t, d, n) in enumerate(rows)],
                                 LOADED.replace(", event_time timestamp", "")).withColumn("event_time", F.to_timestamp("timestamp"))


def test_table_load_and_integrity(spark):
    df = _traffic(spark, [("2023-05-17 10:00:00", "b", 1), ("2023-05-18 10:00:00", "c", 2)])
    assert write_table(df, "nt_test", "modular") == 2
    info = describe_table(spark, "nt_test")
    assert info["exists"] and info["rows"] == 2
    assert write_table(df, "nt_test", "modular", mode="append") == 2
    row = load_checks(spark.table("nt_test"), "modular").first()
    assert (row.rows, row.distinct_src, row.distinct_dst, row.distinct_ids, row.broken_rows) == (4, 1, 2, 4, 0)
    with pytest.raises(ValueError):
        write_table(df, "nt_test", "integrated")
    for bad in (("2023-05-17 10:00:00", None, 1), ("2023-05-17 10:00:00", "b", None)):
        with pytest.raises(Exception, match="NOT NULL"):
            write_table(_traffic(spark, [bad]), "nt_bad", "modular")


def test_integrated_rows_may_lack_a_length(spark):
    df = _traffic(spark, [("2023-05-17 10:00:00", "b", 1), ("2023-05-17 10:00:00", "b", None)])
    df = df.withColumnsRenamed({"src_ip_anon": "src_ip_anonimizada", "dst_ip_anon": "dst_ip_anonimizada"})
    assert write_table(df, "nt_integrated", "integrated") == 2
    assert load_checks(spark.table("nt_integrated"), "integrated").first().broken_rows == 0


def test_replayed_load_leaves_the_table(spark):
    def held():
        return sorted((r.id, r.load_id, r.dst_ip_anon, str(r.event_date)) for r in spark.table("nt_loads").collect())

    a = _traffic(spark, [("2023-05-17 10:00:00", "b", 1), ("2023-05-18 10:00:00", "c", 2)])
    b = _traffic(spark, [("2023-05-18 10:00:00", "d", 3)])
    assert write_load(a, "nt_loads", "modular", "a") == 2
    first = held()
    assert write_load(a, "nt_loads", "modular", "a") == 2 and held() == first
    assert write_load(b, "nt_loads", "modular", "b") == 1
    both = held()
    assert len(both) == 3 and len({i for i, *_ in both}) == 3 and both[:2] == first
    assert write_load(a, "nt_loads", "modular", "a") == 2 and held() == both
    # A corrected load that lost a date leaves nothing of it.
    assert write_load(a.where("dst_ip_anon = 'b'"), "nt_loads", "modular", "a") == 1
    assert held() == [both[0], both[2]]
    with pytest.raises(Exception, match="NOT NULL"):
        write_load(_traffic(spark, [("2023-05-17 10:00:00", "b", None)]), "nt_loads", "modular", "c")


def test_load_writes_few_files_per_date(spark, scratch):
    df = _traffic(spark, [(f"2023-05-{1 + k % 20:02d} 10:00:00", "b", k) for k in range(400)]).repartition(16)
    write_table(df, "nt_files", "modular", path=f"{scratch}/nt_files")
    files = {}
    for folder, _, names in os.walk(f"{scratch}/nt_files"):
        files[folder] = sum(n.endswith(".parquet") for n in names)
    assert sorted(v for k, v in files.items() if "event_date=" in k) == [1] * 20


def test_run_removes_its_intermediate_tables(spark, scratch):
    t = "May 17, 2023 10:44:38.201312000 CEST"
    _write(os.path.join(scratch, "c.csv"), ",", RAW13_FIELDS, [[t, "10.0.2.15", "8.8.8.8", "6", "1234", "443", "", "", "60", "", "", "", ""]])
    # The blank after the comma of the time makes no field: it is quoted as in an export.
    with open(os.path.join(scratch, "c.csv"), "w") as fh:
        fh.write(EXPORT + f'\n"{t}",10.0.2.15,8.8.8.8,6,1234,443,,,60,,,,\n')
    with run(read_export(spark, scratch, "modular", glob="*.csv"), "modular", salt="s") as result:
        assert result.anonymised.count() == 1
        folder = result.workspace.folder.replace("file:", "")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
