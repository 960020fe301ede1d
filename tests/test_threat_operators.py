"""Threat and privacy operators against plain loops."""

import ipaddress
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wiretable.operators import indicators as I
from wiretable.operators.bursts import bursts
from wiretable.operators.masking import agent_family, mask_domain, shift_checks, shift_times
from wiretable.operators.outliers import limits, outliers
from wiretable.operators.sketches import daily_sketches, distinct_between
from wiretable.operators.token_map import grow, replace, restore


def test_address_bits_are_those_of_the_library(spark):
    rng = random.Random(4)
    texts = ["::", "::1", "1::", "fe80::1%eth0", "::ffff:10.0.2.15", "1:2:3:4:5:6:7.8.9.10", "2001:DB8::a:b", " 10.0.0.1 "]
    texts += [str(ipaddress.IPv6Address(rng.getrandbits(128) & rng.getrandbits(128))) for _ in range(50)]
    texts += [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(50)]
    df = I.with_address_bits(spark.createDataFrame([(t,) for t in texts + ["999.1.1.1", "", "x", None]], "a string"), "a")
    got = {r.a: r.bits for r in df.collect()}
    for t in texts:
        ip = ipaddress.ip_address(t.strip().split("%")[0])
        assert got[t] == f"{ip.version}:" + format(int(ip), f"0{ip.max_prefixlen}b"), t
    assert all(got[t] is None for t in ("999.1.1.1", "", "x", None))


def test_ranges_are_cut_into_blocks(spark):
    rng = random.Random(7)
    spans = [(0, 2 ** 32 - 1), (5, 5), (1, 6), (3, 4), (0, 1), (2 ** 32 - 1, 2 ** 32 - 1), (6, 9)]
    spans += [tuple(sorted((rng.getrandbits(32), rng.getrandbits(32)))) for _ in range(40)]
    df = spark.createDataFrame(spans, "low long, high long").select("low", "high", I.range_blocks(F.col("low"), F.col("high")).alias("b"))
    for r in df.collect():
        want = ipaddress.summarize_address_range(ipaddress.IPv4Address(r.low), ipaddress.IPv4Address(r.high))
        assert sorted((x.start, x["size"]) for x in r.b) == sorted((int(n.network_address), n.prefixlen) for n in want)


def test_most_specific_indicator(spark):
    packets = [(1, "10.1.2.3", "8.8.8.8", "a.b.evil.com"), (2, "10.9.9.9", "10.1.2.200", "EVIL.com."), (3, "2001:db8::5", "x", "notevil.com"),
               (4, None, None, None), (5, "10.1.2.3", "10.1.2.3", "c.evil.com")]
    marks = [("address", x) for x in ("10.0.0.0/8", "10.1.0.0/16", "10.1.2.0-10.1.2.127", "2001:db8::/32", "0.0.0.0/33", "bad", "::/0")]
    marks += [("domain", x) for x in ("evil.com", "b.evil.com", "")]
    got = {r.packet_id: tuple(r)[1:] for r in I.indicator_match(
        spark.createDataFrame(packets, "packet_id long, src_ip string, dst_ip string, dns_query string"),
        spark.createDataFrame(marks, "kind string, indicator string")).collect()}
    assert got == {1: ("10.1.2.0-10.1.2.127", None, "b.evil.com"), 2: ("10.0.0.0/8", "10.1.0.0/16", "evil.com"),
                   3: ("2001:db8::/32", None, None), 5: ("10.1.2.0-10.1.2.127", "10.1.2.0-10.1.2.127", "evil.com")}


def test_indicator_plan_has_no_nested_loop(spark):
    packets = spark.createDataFrame([(1, "10.1.2.3", "8.8.8.8", "a.b")], "packet_id long, src_ip string, dst_ip string, dns_query string")
    marks = spark.createDataFrame([("address", "10.0.0.0/8"), ("domain", "b")], "kind string, indicator string")
    plan = I.indicator_match(packets, marks)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def plain_bursts(rows, window):
    times = defaultdict(list)
    for k, t in rows:
        if t is not None:
            times[k].append(t)
    out = {}
    for k, ts in times.items():
        ts.sort()
        low, counts = 0, []
        for high, t in enumerate(ts):
            while ts[low] <= t - window:
                low += 1
            counts.append((high - low + 1, -t))
        # Equal times count together: the last of them has them all.
        most, at = max(counts)
        out[k] = (len(ts), most, -at)
    return out


@pytest.mark.parametrize("window", [1, 7, 64, 100, 1000, 6400])
def test_bursts_equal_two_pointers(spark, window):
    rng = random.Random(window)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(-3000, 3000)) for _ in range(600)] + [("hot", rng.randrange(500)) for _ in range(900)]
    rows += [("edge", t) for t in (0, window - 1, window, 2 * window - 1, -window)] + [("a", None)]
    got = {r.k: (r.events, r.most, r["at"]) for r in bursts(spark.createDataFrame(rows, "k string, t long"), ["k"], "t", window).collect()}
    assert got == plain_bursts(rows, window)


def test_hot_key_is_spread_over_its_time(spark):
    """The frames of one key with most rows: no partition of a frame holds more than a small part of it."""
    hot = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 10).alias("t"))
    window = 6400
    by_slice = hot.groupBy("k", F.expr(f"t * 64 div {window}").alias("s")).count().agg(F.max("count")).first()[0]
    assert by_slice <= 20
    r = bursts(hot, ["k"], "t", window).first()
    assert (r.events, r.most) == (20_000, 640)


def test_outliers_by_both_rules(spark):
    rng = random.Random(2)
    rows = [(i, "p", int(rng.gauss(100, 10))) for i in range(500)] + [(900, "p", 1000), (901, "q", 5), (902, "q", 5), (903, "p", None), (904, None, 7)]
    got = {r.packet_id: (r.by_z, r.by_iqr) for r in outliers(spark.createDataFrame(rows, "packet_id long, g string, v int"), "g", "v").collect()}
    values = [v for _, g, v in rows if g == "p" and v is not None]
    mean = sum(values) / len(values)
    spread = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
    assert got[900] == (True, True) and not {901, 902, 903, 904} & set(got)
    assert {i for i, (z, _) in got.items() if z} == {i for i, g, v in rows if g == "p" and v is not None and abs(v - mean) > 3 * spread}


def test_sketched_quartiles_have_bounded_rank_error(spark):
    rng = random.Random(3)
    values = [int(rng.expovariate(0.001)) for _ in range(20_000)]
    df = spark.createDataFrame([("p", v) for v in values], "g string, v int").repartition(8)
    r = limits(df, "g", "v", exact=False, accuracy=200).first()
    values.sort()
    for q, found in ((0.25, r.q1), (0.75, r.q3)):
        low = sum(v < found for v in values) / len(values)
        high = sum(v <= found for v in values) / len(values)
        assert low - 1 / 200 <= q <= high + 1 / 200


def test_token_map_grows_without_gaps(spark):
    first = [("a",), ("b",), ("a",), (None,), ("",)] + [(f"x{k}",) for k in range(200)]
    one = grow(None, spark.createDataFrame(first, "value string").repartition(5))
    old = {r.value: r.token for r in one.collect()}
    assert sorted(old.values()) == list(range(202))
    two = grow(one, spark.createDataFrame([("b",), ("new",), (None,)] + [(f"y{k}",) for k in range(90)], "value string").repartition(4))
    new = {r.value: r.token for r in two.collect()}
    assert sorted(new.values()) == list(range(293)) and all(new[v] == t for v, t in old.items())
    rows = spark.createDataFrame([(1, "a", "new"), (2, None, "x7"), (3, "y3", "")], "i long, s string, d string")
    coded = replace(rows, two, ["s", "d"])
    assert {r.i: (r.s, r.d) for r in coded.collect()} == {1: (new["a"], new["new"]), 2: (None, new["x7"]), 3: (new["y3"], None)}
    assert {tuple(r) for r in restore(coded, two, ["s", "d"]).select("i", "s", "d").collect()} == {(1, "a", "new"), (2, None, "x7"), (3, "y3", None)}
    with pytest.raises(Exception, match="has no token"):
        replace(spark.createDataFrame([(1, "unknown")], "i long, s string"), two, ["s"]).collect()


def test_masked_domains_keep_their_parents(spark):
    names = ["a.x.es", "b.x.es", "x.es", "a.y.es", "es", "", None, "A.X.es"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", mask_domain(F.col("n"), "salt").alias("m"))
    got = [r.m for r in df.collect()]
    assert got[0].split(".")[1:] == got[1].split(".")[1:] == got[2].split(".") and got[0] != got[1] and got[0] == got[7]
    assert got[3].split(".")[1] != got[0].split(".")[1] and got[0].endswith(".es") and "x" not in got[2].split(".")[0][:1]
    assert got[4:7] == ["es", "", None]
    assert got[2] == "82b38ba4b0e6.es" or len(got[2]) == 15


def test_time_shift_check_finds_damage(spark):
    rows = [(i, i % 7, i * 3) for i in range(100)]
    before = spark.createDataFrame(rows, "packet_id long, f int, t long")
    after = shift_times(before, ["f"], "t", "salt", 1000)
    ok = shift_checks(before, after, ["f"], "t").first()
    assert (ok.flows, ok.broken_flows, ok.missing_rows) == (7, 0, 0) and ok.moved_flows >= 6
    bad = after.withColumn("t", F.when(F.col("packet_id") == 50, F.col("t") + 1).otherwise(F.col("t"))).where("packet_id <> 3")
    r = shift_checks(before, bad, ["f"], "t").first()
    assert (r.broken_flows, r.missing_rows) == (1, 1)


def test_sketches_merge_over_dates(spark):
    rows = spark.range(60_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 7001).cast("string").alias("v"))
    held = daily_sketches(rows, "day", ["v"])
    for low, high in ((None, None), (2, 4)):
        exact = rows.where("true" if low is None else f"day between {low} and {high}").select("v").distinct().count()
        r = distinct_between(held, "day", ["v"], low, high).first()
        assert abs(r.v - exact) <= 0.05 * exact and r.days == (10 if low is None else 3)


def test_agent_families(spark):
    agents = {
        "Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/115.0": "Firefox",
        "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/113.0.0.0 Safari/537.36": "Chrome",
        "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/113.0.0.0 Safari/537.36 Edg/113.0": "Edge",
        "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/99.0 Safari/537.36 OPR/85.0": "Opera",
        "Mozilla/5.0 (Macintosh) AppleWebKit/605.1.15 Version/16.4 Safari/605.1.15": "Safari",
        "Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko": "Internet Explorer",
        "Mozilla/5.0 (compatible; Googlebot/2.1) Chrome/100.0": "Bot", "curl/8.0.1": "Command line", "agent/1.0": "Other", "": None, None: None,
    }
    df = spark.createDataFrame([(a,) for a in agents], "agent string")
    assert {r.agent: r.family for r in df.select("agent", agent_family(F.col("agent")).alias("family")).collect()} == agents
