"""Flow thinning (D2) against a plain sequential loop; D1 and D3 rules."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from wiretable.operators.dedup import SLICES, drop_exact, first_per_key, thin_flows


def greedy(rows, w):
    flows = defaultdict(list)
    for key, t, pid in rows:
        flows[key].append((t, pid))
    kept = set()
    for items in flows.values():
        last = None
        for t, pid in sorted(items):
            if last is None or t - last >= w:
                kept.add(pid)
                last = t
    return kept


def test_fixture_window_60(spark):
    times = [0, 30, 59, 61, 90, 121, 200]
    df = spark.createDataFrame([("a", t, i) for i, t in enumerate(times)], "f string, t long, pid long")
    out = thin_flows(df, ["f"], "t", 60, order_col="pid")
    assert sorted(r.t for r in out.collect()) == [0, 61, 121, 200]


def test_gap_exactly_window_and_interleaved(spark):
    rows = [("a", 0, 0), ("b", 10, 1), ("a", 60, 2), ("b", 69, 3), ("a", 60, 4), ("b", 70, 5),
            (None, 5, 6), (None, 64, 7), (None, 65, 8)]
    df = spark.createDataFrame(rows, "f string, t long, pid long")
    for bound in (4096, 0):
        got = {r.pid for r in thin_flows(df, ["f"], "t", 60, order_col="pid", fold_max_nodes=bound).collect()}
        assert got == greedy([(f, t, p) for f, t, p in rows], 60) == {0, 2, 1, 5, 6, 8}


def test_random_flows_match_loop(spark):
    rng = random.Random(7)
    rows, pid = [], 0
    for flow in range(40):
        t = rng.randint(0, 1000)
        for _ in range(rng.randint(1, 120)):
            t += rng.choice([0, 0, 1, 3, 9, 10, 11, 25, 60, 400])
            key = None if flow % 9 == 0 else f"k{flow % 13}"
            rows.append((key, t, pid))
            pid += 1
    df = spark.createDataFrame(rows, "f string, t long, pid long")
    # fold only (default bound), doubling only, and mixed routing (bound 40)
    for w, bound in ((1, 4096), (10, 4096), (37, 4096), (10, 0), (37, 0), (10, 40)):
        got = {r.pid for r in thin_flows(df, ["f"], "t", w, order_col="pid",
                                         fold_max_nodes=bound).collect()}
        assert got == greedy(rows, w), (w, bound)


def test_null_times_pass_through(spark):
    df = spark.createDataFrame([("a", None, 0), ("a", 1, 1), ("a", 2, 2)], "f string, t long, pid long")
    got = sorted(r.pid for r in thin_flows(df, ["f"], "t", 10, order_col="pid").collect())
    assert got == [0, 1]


def test_untimed_rows_of_timed_flows_can_go(spark):
    df = spark.createDataFrame([("a", None, 0), ("a", 1, 1), ("b", None, 2), ("b", None, 3), (None, None, 4)],
                               "f string, t long, pid long")
    got = sorted(r.pid for r in thin_flows(df, ["f"], "t", 10, order_col="pid", untimed_rows="first").collect())
    assert got == [1, 2, 4]


def test_idempotent(spark):
    rng = random.Random(3)
    rows = [(f"k{rng.randint(0, 4)}", rng.randint(0, 500), i) for i in range(400)]
    df = spark.createDataFrame(rows, "f string, t long, pid long")
    once = thin_flows(df, ["f"], "t", 20, order_col="pid")
    twice = thin_flows(once, ["f"], "t", 20, order_col="pid")
    assert sorted(r.pid for r in once.collect()) == sorted(r.pid for r in twice.collect())


def test_drop_exact_keeps_first(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "b", "x")], "pid long, v string, w string")
    out = sorted((r.pid, r.v) for r in drop_exact(df, ["v", "w"], "pid").collect())
    assert out == [(1, "a"), (2, "b")]


def test_first_per_key_orders_nulls_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 3, 3), ("b", None, 4)],
                               "k string, t long, pid long")
    out = {r.k: r.pid for r in first_per_key(df, ["k"], ["t"], "pid").collect()}
    assert out == {"a": 3, "b": 4}


def test_dense_bucket_is_spread(spark):
    """Every packet of one flow inside one window: the as-of partitions hold a slice of it each."""
    rng = random.Random(9)
    w = 60_000_000_000
    times = sorted(rng.sample(range(w + 5), 3000)) + [2 * w + 1, 2 * w + 9, 3 * w + 5]
    rows = [("one", t, k) for k, t in enumerate(times)]
    df = spark.createDataFrame(rows, "f string, t long, pid long")
    got = {r.pid for r in thin_flows(df, ["f"], "t", w, order_col="pid", fold_max_nodes=0).collect()}
    assert got == greedy(rows, w)
    slices = df.where(F.col("t") < w).groupBy(F.expr(f"t * {SLICES} div {w}")).count()
    largest = slices.agg(F.max("count"), F.count("*")).first()
    assert largest[0] < 3000 / 16 and largest[1] == SLICES


def test_plan_has_no_python(spark):
    df = spark.range(100).select(F.col("id").alias("pid"), (F.col("id") % 7).alias("f"),
                                 (F.col("id") * 13 % 50).alias("t"))
    out = thin_flows(df, ["f"], "t", 5, order_col="pid")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_nanosecond_epochs_and_negative_times(spark):
    w = 60_000_000_000
    base = 1_684_320_272_000_000_000
    rng = random.Random(5)
    rows, pid = [], 0
    for flow, start in (("a", base), ("b", base + w - 1), ("c", -3 * w - 7)):
        t = start
        for _ in range(60):
            t += rng.choice([0, 1, w // 2, w - 1, w, w + 1, 3 * w])
            rows.append((flow, t, pid))
            pid += 1
    df = spark.createDataFrame(rows, "f string, t long, pid long")
    for bound in (4096, 0):
        got = {r.pid for r in thin_flows(df, ["f"], "t", w, order_col="pid", fold_max_nodes=bound).collect()}
        assert got == greedy(rows, w)


def test_ids_that_grow_with_the_rows_are_not_broadcast(spark):
    rows = [("a", 10 * k, k, f"x{k % 7}") for k in range(200)]
    df = spark.createDataFrame(rows, "f string, t long, pid long, text string")
    for out, kept in ((drop_exact(df, ["f", "text"], "pid"), set(range(7))),
                      (thin_flows(df, ["f"], "t", 60, order_col="pid"), set(range(0, 200, 6)))):
        assert {r.pid for r in out.collect()} == kept
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_flows_of_thousands_of_times_are_folded_and_match_loop(spark):
    rng = random.Random(5)
    rows, t = [], 0
    for pid in range(5000):
        t += rng.choice([1, 2, 9, 10, 30])
        rows.append(("a" if pid % 5 else "b", t, pid))
    df = spark.createDataFrame(rows, "f string, t long, pid long")
    for w in (1, 10, 500):
        out, stats = thin_flows(df, ["f"], "t", w, order_col="pid", with_stats=True)
        assert stats == {"levels": 0, "large_flows": 0}
        assert sorted(r.pid for r in out.collect()) == sorted(greedy(rows, w))
