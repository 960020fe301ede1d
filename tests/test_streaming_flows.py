"""Streaming thinning and scan alerts against the batch operators, with restarts."""

import os
import random

from pyspark.sql import functions as F

from wiretable.operators.dedup import thin_flows
from wiretable.streaming.flows import scan_alerts, sketch_stream, thin_to_tables, port_sketches

SCHEMA = "packet_id long, t_us long, src_ip string, dst_ip string, dst_port_n int"
SECOND = 1_000_000


def drop(spark, folder, name, rows):
    """One file of the stream's folder."""
    path = os.path.join(folder, name)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(path + ".tmp")
    part = next(f for f in os.listdir(path + ".tmp") if f.endswith(".json"))
    os.makedirs(os.path.join(folder, "in"), exist_ok=True)
    os.replace(os.path.join(path + ".tmp", part), os.path.join(folder, "in", name + ".json"))


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(os.path.join(folder, "in"))


def test_thinning_in_order_equals_batch_over_restarts(spark, scratch):
    rng = random.Random(9)
    times = sorted(rng.randrange(0, 400 * SECOND) for _ in range(600))
    rows = [(i, t, rng.choice(["a", "b", None]), rng.choice(["x", "y"]), 80) for i, t in enumerate(times)]
    key, window = ["src_ip", "dst_ip"], 20 * SECOND

    def go():
        thin_to_tables(stream(spark, scratch), key, window, "5 seconds", f"{scratch}/out", f"{scratch}/ckpt").awaitTermination(180)

    drop(spark, scratch, "a", rows[:250])
    go()
    drop(spark, scratch, "b", rows[250:400])
    drop(spark, scratch, "c", rows[400:])
    go()  # a new query goes on from the checkpoint
    batch = thin_flows(spark.createDataFrame(rows, SCHEMA), key, "t_us", window)
    want = sorted(r.packet_id for r in batch.collect())
    assert sorted(r.packet_id for r in spark.read.parquet(f"{scratch}/out/kept").collect()) == want
    assert spark.read.parquet(f"{scratch}/out/late").count() == 0
    # A packet behind what its flow has judged goes to the side table and changes nothing; an expired flow starts anew.
    drop(spark, scratch, "d", [(9000, rows[-1][1] - 2 * SECOND, rows[-1][2], rows[-1][3], 80), (9001, 5000 * SECOND, "a", "x", 80)])
    go()
    kept = {r.packet_id for r in spark.read.parquet(f"{scratch}/out/kept").collect()}
    assert kept - set(want) == {9001}
    assert [r.packet_id for r in spark.read.parquet(f"{scratch}/out/late").collect()] == [9000]


def test_alerts_equal_the_batch_answer_within_the_error(spark, scratch):
    rng = random.Random(1)
    rows = [(i, i * SECOND // 4, f"s{i % 7}", "d", rng.randrange(1, 60) * (1 if i % 7 else 300) + i % 7) for i in range(4000)]
    for k in range(4):
        drop(spark, scratch, f"f{k}", rows[1000 * k:1000 * (k + 1)])
    drop(spark, scratch, "z", [(9999, 10 ** 10, "late", "d", 1)])  # moves the watermark past the last window
    sketch_stream(stream(spark, scratch), "60 seconds", "10 seconds", f"{scratch}/sk", f"{scratch}/ck").awaitTermination(180)
    df = spark.createDataFrame(rows, SCHEMA)
    exact = {r.src_ip: r.n for r in df.groupBy("src_ip").agg(F.count_distinct("dst_port_n").alias("n")).collect()}
    found = {r.src_ip: r.ports for r in scan_alerts(spark.read.parquet(f"{scratch}/sk"), 0).collect()}
    same = {r.src_ip: r.ports for r in scan_alerts(port_sketches(df, "60 seconds", ""), 0).collect()}
    assert found == same and set(found) == set(exact)
    assert max(abs(found[s] - n) / n for s, n in exact.items()) <= 3 * 0.83 / 2 ** 6
