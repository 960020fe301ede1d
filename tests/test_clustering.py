"""The Z-order access path: the key, the row groups that lookups read, hot flows."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from wiretable.plans.clustering import order_number, rank_cuts, spread_bits, with_z_key, write_clustered
from wiretable.plans.tables import write_table

COLUMNS = ["src_ip_anon", "dst_ip_anon", "dst_port", "event_time"]


def row_groups(folder, **wanted):
    """Row groups in all, and those whose minima and maxima admit the wanted values."""
    total = read = 0
    for file in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics
                     for c in range(meta.num_columns)}
            total += 1
            read += all(stats[k].has_min_max and stats[k].min <= v <= stats[k].max for k, v in wanted.items())
    return total, read


def test_ranks_and_bits():
    assert rank_cuts([5, 5, 5, 9]) == [5, 6, 9] and rank_cuts([]) == []
    assert len(rank_cuts([k // 2 for k in range(63)])) <= 63
    assert spread_bits(0b101, 1, 4) == 0b1000000010
    keys = {spread_bits(a, 0, 2) | spread_bits(b, 1, 2) for a in range(64) for b in range(64)}
    assert keys == set(range(64 * 64))


def test_order_of_texts_and_nulls(spark):
    texts = [None, "", "0", "00", "0a", "ff", "é", "日本"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = df.withColumn("n", order_number(F.col("t"), df.schema["t"].dataType)).orderBy("k").collect()
    assert [r.n for r in got] == sorted(r.n for r in got) and len({r.n for r in got}) == len(texts)


def test_keys_follow_the_ranks(spark):
    rows = [(k, k % 64, (k * 7) % 64) for k in range(64 * 64)]
    found, n = with_z_key(spark.createDataFrame(rows, "packet_id long, a int, b int"), ["a", "b"])
    assert n == len(rows) and found.columns == ["packet_id", "a", "b", "_z"]
    for r in found.collect():
        a = sum(((r._z >> (2 * k)) & 1) << k for k in range(6))
        b = sum(((r._z >> (2 * k + 1)) & 1) << k for k in range(6))
        assert abs(a - r.a) <= 1 and abs(b - r.b) <= 1


def shares(t, wanted, folder):
    """Mean share of the row groups that the lookups of each kind read."""
    found = {}
    for keys in wanted:
        rows = [r.asDict() for r in t.select(*keys).distinct().orderBy(F.xxhash64(*keys)).limit(25).collect()]
        read = [row_groups(folder, **w) for w in rows]
        found[keys] = sum(r for _, r in read) / sum(n for n, _ in read)
    return found


def test_lookups_read_fewer_row_groups(spark, scratch):
    """Many sources and destinations, all pairs alike: the first path serves destinations and pairs only."""
    part = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    pseudonym = lambda c: F.left(F.sha2(c.cast("string"), 256), F.lit(16))
    t = spark.range(40_000).select(
        F.col("id").alias("packet_id"), pseudonym(part(1, 400)).alias("src_ip_anon"), pseudonym(part(2, 400) + 1000).alias("dst_ip_anon"),
        part(3, 60).cast("int").alias("dst_port"), F.timestamp_micros(part(4, 86_400_000_000)).alias("event_time"),
        F.lit("TCP").alias("protocol"), F.lit("t").alias("timestamp"), F.lit(60).alias("length"))
    write_clustered(t, "nt_clustered", COLUMNS, rows_per_file=160, path=f"{scratch}/z")
    write_table(t.repartitionByRange(250, "dst_ip_anon", "src_ip_anon", "protocol"), "nt_sorted", "modular", partition_col=None,
                path=f"{scratch}/s")
    assert sorted(spark.table("nt_clustered").columns) == sorted(t.columns)
    source, port, flow, destination = ("src_ip_anon",), ("dst_port",), ("src_ip_anon", "dst_ip_anon", "dst_port"), ("dst_ip_anon",)
    z, s = (shares(t, (source, port, flow, destination), f"{scratch}/{k}") for k in "zs")
    print("clustered", z, "sorted", s)
    assert z[source] < 0.7 * s[source] and z[port] < 0.7 * s[port]  # file bounds are sampled
    assert z[flow] < 0.1 and z[destination] < 0.5


def test_hot_flow_is_dealt_over_files(spark, scratch):
    rows = [(k, "aaaaaaaa", "bbbbbbbb", 443) for k in range(8000)] + [(8000 + k, f"{k:08x}", "cccccccc", k % 7) for k in range(2000)]
    df = spark.createDataFrame(rows, "packet_id long, src string, dst string, port int")
    assert write_clustered(df, "nt_hot", ["src", "dst", "port"], rows_per_file=1000, path=f"{scratch}/hot") == 10000
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{scratch}/hot/*.parquet")]
    assert len(sizes) == 10 and max(sizes) < 2000


def test_empty_table(spark, scratch):
    df = spark.createDataFrame([], "packet_id long, src string, at timestamp")
    assert write_clustered(df, "nt_none", ["src", "at"], path=f"{scratch}/none") == 0
    assert os.path.isdir(f"{scratch}/none") and spark.table("nt_none").count() == 0
