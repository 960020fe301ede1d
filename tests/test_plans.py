"""Physical-plan properties: pushdown, pruning, top-k, no Python in the plan."""

from compare import SF001
from wiretable.operators import analytics as Q
from wiretable.plans.registry import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pipeline_has_no_python_nodes(spark):
    for name in ("cleaned_rows_integrated", "signals_modular", "q2_top_destinations"):
        plan = _plan(QUERIES[name](spark, SF001))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns_and_pushes_filters(spark, scratch):
    df = spark.createDataFrame([(1, "a", 53), (2, "b", 80)], "id long, dns_query string, dst_port int")
    df.write.parquet(f"{scratch}/t")
    t = spark.read.parquet(f"{scratch}/t")
    plan = _plan(Q.q3_top_domains(t))
    assert "PushedFilters: [IsNotNull(dns_query), Not(EqualTo(dns_query,))]" in plan
    assert "ReadSchema: struct<dns_query:string>" in plan
    assert "TakeOrderedAndProject" in _plan(Q.q4_top_ports(t))


def test_top_k_ties_broken_by_key(spark):
    rows = [(p,) for p in [3, 3, 1, 1, 2, 2, 9]]
    t = spark.createDataFrame(rows, "dst_port int")
    out = [r.dst_port for r in Q.q4_top_ports(t, k=2).collect()]
    assert out == [1, 2]


def test_cleaning_writes_once_and_sorts_no_wide_rows(spark):
    from wiretable import session
    from wiretable.operators import dedup
    from wiretable.plans import pipeline, registry

    written = []

    def spy(module, name):
        real = getattr(module, name)

        def called(df, **metrics):
            written.append(df.columns)
            return real(df, **metrics)
        setattr(module, name, called)
        return real

    real = [(m, spy(m, "materialize_observed")) for m in (pipeline, dedup, session)]
    try:
        result = registry.cleaned(spark, SF001, registry.MODULAR)
        exact = _plan(result.deduplicated)
    finally:
        for module, function in real:
            module.materialize_observed = function
    assert sum("http_path" in columns for columns in written) == 1
    assert "SortAggregate" not in exact and "SortAggregate" not in _plan(result.clean)


def test_protocol_share_uses_scalar_subquery(spark):
    t = spark.createDataFrame([("TCP",), ("TCP",), ("UDP",)], "protocol string")
    out = {r.protocol: r.percentage for r in Q.q6_protocol_share(t).collect()}
    assert out == {"TCP": 66.67, "UDP": 33.33}
    assert "Subquery" in _plan(Q.q6_protocol_share(t))
