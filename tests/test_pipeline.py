"""Pipeline invariants on the packet view (sf0.001) and a hot-flow thinning case."""

import random

from pyspark.sql import functions as F

from compare import SF001
from test_dedup import greedy
from wiretable.operators import analytics as Q
from wiretable.operators.dedup import thin_flows
from wiretable.plans import registry as R
from wiretable.plans.pipeline import clean, clean_counters
from wiretable.schema import INTEGRATED, MODULAR


def test_rows_are_accounted_for(spark):
    for prof in (INTEGRATED, MODULAR):
        ex = R.extracted(spark, SF001, prof)
        cr = clean(ex, prof)
        counters = {r.counter: r.value for r in clean_counters(cr, prof).collect()}
        rejects = sum(v for k, v in counters.items() if k.startswith("invalid_") or k == "missing_required")
        assert counters["initial"] == rejects + counters["validated"]
        assert counters["validated"] == (counters["exact_duplicates"] + counters["flow_duplicates"]
                                         + counters["final"])
        assert cr.clean.count() == counters["final"]
        # Thinning its own output changes nothing.
        again = thin_flows(cr.clean, prof.flow_key, "event_ns", prof.flow_window_ns)
        assert again.count() == counters["final"]


def test_protocol_shares_sum_to_100(spark):
    t = R.network_traffic(spark, SF001)
    shares = [r.percentage for r in Q.q6_protocol_share(t).collect()]
    assert abs(sum(shares) - 100) < 0.05
    assert Q.q1_total(t).first().total_records == sum(r["count"] for r in Q.q6_protocol_share(t).collect())


def test_hot_flow_long_chain(spark):
    rng = random.Random(11)
    t, rows = 0, []
    for i in range(1200):
        t += rng.choice([1, 2, 3, 5, 8])
        rows.append(("hot", t, i))
    df = spark.createDataFrame(rows, "f string, t long, pid long")
    # Above the fold bound: the flow goes through pointer doubling.
    out, stats = thin_flows(df, ["f"], "t", 10, order_col="pid", with_stats=True, fold_max_nodes=500)
    assert {r.pid for r in out.collect()} == greedy(rows, 10)
    assert stats["levels"] >= 6 and stats["large_flows"] == 1
    # Below the bound the same flow is folded directly, with the same result.
    out, stats = thin_flows(df, ["f"], "t", 10, order_col="pid", with_stats=True, fold_max_nodes=4096)
    assert {r.pid for r in out.collect()} == greedy(rows, 10)
    assert stats == {"levels": 0, "large_flows": 0}


def test_keep_flagged_exempts_signals(spark):
    ex = R.extracted(spark, SF001, INTEGRATED)
    cr = clean(ex, INTEGRATED, keep_flagged=True)
    attack = F.col("is_attack_pattern")
    assert cr.clean.where(attack).count() == cr.deduplicated.where(attack).count()
