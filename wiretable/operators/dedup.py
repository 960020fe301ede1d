"""De-duplication: exact (D1), first per key (D3), greedy flow thinning.

D1 takes the least row id of each group (a hash aggregation), D3 the least
``struct(order, payload)``; both aggregate partially on the map side, so a hot
group never lands whole in one task.

D2 keeps, per flow in time order, the first packet and then every packet at
least ``W`` after the *last kept* one.  That is a sequential fold.  Flows are
sized first; a flow with a bounded number of distinct times is folded
directly (JVM-side ``aggregate`` over its sorted times, one grouped
aggregation).  Larger flows, of any size, are rebuilt exactly without
collecting any group, as a pointer-doubling job over the distinct (flow, time)
nodes:

1. ``next(t)`` = first node ``>= t + W`` of the same flow.  With time buckets
   of width ``W`` it lies in bucket ``b(t)+1`` or is the minimum of bucket
   ``b(t)+2``.  Buckets are cut into ``SLICES`` slices; ``t + W`` lies in the
   same slice of its bucket as ``t``.  The first node is found by an as-of
   lookup inside that slice (a window partitioned by flow, bucket *and* slice, so
   a dense flow is spread within ``W`` too), else it is the minimum of the next
   filled slice of the bucket, else of bucket ``b(t)+2`` (one bucket-level join
   that carries at most ``SLICES`` minima).
2. A node whose predecessor is ``>= W`` earlier (a *session start*) is always
   kept, since the last kept node cannot be later than that predecessor.
   Pointers into a start are cut, so chains stay inside one session.
3. Kept nodes = the chains from every start.  Pointer doubling
   (``J[k+1] = J[k] o J[k]``) followed by binary expansion from the starts
   finds them in ``2 * ceil(log2(longest chain))`` joins.  Pointers are node
   ids (the representative ``order_col`` value), so each level moves two
   longs per node.  Each level is written to the checkpoint folder, which
   cuts lineage and survives executor loss.

Every step of that path is a join, an aggregation or a bounded window; no
step gathers a large flow (or a session) into one task or one array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, materialize_counted, materialize_observed

#: Slices of a bucket of the large-flow path.
SLICES = 64
#: Kept ids of a run in the fold of a small flow.
FOLD_RUN = 128
#: Pointers of a level that may be broadcast (16 bytes each).
LEVEL_BROADCAST_MAX = 100_000


def drop_exact(df: DataFrame, columns: list[str], order_col: str = "packet_id") -> DataFrame:
    """One row per distinct value of ``columns``; the first by ``order_col`` wins.

    NULLs compare equal, as in a pandas ``drop_duplicates``.  ``order_col`` is a
    number that identifies rows: its minimum per group is a hash aggregation
    (partial before the shuffle); columns outside ``columns`` are brought back
    by a semi-join on it, which sorts: its ids grow with the rows, so they are never
    broadcast through the driver, however well they compress in a shuffle.
    """
    first = df.groupBy(*columns).agg(F.min(order_col).alias(order_col))
    if set(df.columns) == {order_col, *columns}:
        return first.select(*df.columns)
    return df.join(first.select(order_col).hint("merge"), order_col, "left_semi")


def first_per_key(df: DataFrame, key: list[str], order: list[str],
                  order_col: str = "packet_id") -> DataFrame:
    """First row per ``key`` by ``order`` (NULL orders last), then ``order_col``."""
    rest = [c for c in df.columns if c not in key]
    sort_key = []
    for c in order:
        sort_key += [F.col(c).isNull(), F.col(c)]
    sort_key.append(F.col(order_col))
    payload = F.struct(F.struct(*sort_key).alias("k"), F.struct(*[F.col(c) for c in rest]).alias("row"))
    out = df.groupBy(*key).agg(F.min(payload).alias("_first"))
    return out.select(*[F.col(c) for c in key],
                      *[F.col(f"_first.row.{c}").alias(c) for c in rest]).select(*df.columns)


def thin_flows(df: DataFrame, key: list[str], time_col: str, window: int,
               order_col: str = "packet_id", with_stats: bool = False,
               fold_max_nodes: int = 16_384, route_broadcast_max: int = 1_000_000,
               untimed_rows: str = "keep"):
    """Greedy per-flow thinning with window ``window`` (same unit as ``time_col``).

    ``time_col`` must be an integral epoch value (e.g. nanoseconds).  Flows
    are the distinct values of ``key`` (NULLs equal).  ``order_col`` must
    identify rows.  Of several rows with the same flow and time, the one with
    the smallest ``order_col`` stands for them.  Rows without a time cannot be
    placed: they are passed through (``untimed_rows="keep"``), or only the first
    of a flow that has no timed row stays (``"first"``).

    Flows are sized first.  Flows with at most ``fold_max_nodes`` distinct
    times are thinned by a sequential fold over their sorted times inside one
    grouped aggregation (a group of proven, bounded size; the fold's cost is
    about linear, the bound is there for the memory of a group); larger flows
    take the pointer-doubling path, which never gathers a flow.  The set of large
    flows is counted and broadcast only below ``route_broadcast_max`` rows.
    ``fold_max_nodes=0`` sends every flow through pointer doubling.
    """
    if window <= 0:
        raise ValueError("window must be positive")
    w = int(window)
    c = F.col
    fk = F.struct(*[F.col(k) for k in key]).alias("_fk")
    t = F.col(time_col)
    timed = df.where(t.isNotNull())
    untimed = df.where(t.isNull())

    nodes = (timed.groupBy(fk, t.cast("long").alias("_t"))
             .agg(F.min(order_col).cast("long").alias("_rep")))
    nodes = materialize(nodes.withColumn("_b", F.expr(f"(_t - pmod(_t, {w})) div {w}"))
                        .withColumn("_node", F.struct("_t", "_rep")))

    parts, levels, n_large = [], 0, None
    small_nodes, big_nodes = None, nodes
    if fold_max_nodes > 0:
        sizes = nodes.groupBy("_fk").agg(F.count(F.lit(1)).alias("_cnt"))
        sizes, seen = materialize_observed(sizes, flows=F.count(F.lit(1)),
                                           big=F.count_if(c("_cnt") > fold_max_nodes))
        n_large = int(seen["big"])
        if seen["big"] == 0:                      # every flow is small
            small_nodes, big_nodes = nodes, None
        elif seen["big"] < seen["flows"]:         # route by the (counted) set of big flows
            big = sizes.where(c("_cnt") > fold_max_nodes).select("_fk", F.lit(True).alias("_big"))
            route = F.broadcast(big) if seen["big"] <= route_broadcast_max else big
            routed = nodes.join(route, "_fk", "left")
            small_nodes = routed.where(c("_big").isNull()).drop("_big")
            big_nodes = materialize(routed.where(c("_big")).drop("_big"))
    if small_nodes is not None:
        parts.append(_fold_small_flows(small_nodes, w))
    if big_nodes is not None:
        kept_big, levels = _pointer_doubling(big_nodes, w)
        parts.append(kept_big)

    kept = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if untimed_rows == "first":
        # Flows are compared as structs, so NULL key parts are equal.
        alone = untimed.groupBy(fk).agg(F.min(order_col).alias("_rep")).join(
            nodes.select("_fk").distinct().hint("merge"), "_fk", "left_anti")
        untimed = untimed.join(alone, F.col(order_col) == alone["_rep"], "left_semi")
    out = (timed.join(kept.hint("merge"), F.col(order_col).cast("long") == kept["_rep"], "left_semi")
           .unionByName(untimed))
    if with_stats:
        return out, {"levels": levels, "large_flows": n_large}
    return out


def _fold_small_flows(nodes: DataFrame, w: int) -> DataFrame:
    """Kept node ids of bounded flows: the greedy rule as a fold over the
    flow's sorted (time, id) pairs, evaluated JVM-side per group.

    Kept ids are gathered in runs of ``FOLD_RUN``, as an append copies its array."""
    fold = F.expr(f"""aggregate(
        array_sort(collect_list(_node)),
        named_struct('last', CAST(NULL AS BIGINT), 'run', CAST(array() AS ARRAY<BIGINT>),
                     'runs', CAST(array() AS ARRAY<ARRAY<BIGINT>>)),
        (acc, x) -> IF(acc.last IS NULL OR x._t - acc.last >= {w},
                       IF(size(acc.run) < {FOLD_RUN},
                          named_struct('last', x._t, 'run', array_append(acc.run, x._rep), 'runs', acc.runs),
                          named_struct('last', x._t, 'run', array(x._rep), 'runs', array_append(acc.runs, acc.run))),
                       acc),
        acc -> flatten(array_append(acc.runs, acc.run)))""")
    return nodes.groupBy("_fk").agg(fold.alias("_kept")).select(F.explode("_kept").alias("_rep"))


def _pointer_doubling(nodes: DataFrame, w: int) -> tuple[DataFrame, int]:
    """Kept node ids of arbitrarily large flows, without gathering any flow."""
    c = F.col
    nodes = nodes.withColumn("_s", F.expr(f"(_t - _b * {w}) * {SLICES} div {w}"))
    # Bucket table, one row per (flow, bucket b) with what the lookups need:
    # b's first node and whether it starts a session (gap from b-1's max >= W),
    # the same for b+1, and the first nodes of b's slices.  Each bucket's stats are
    # sent to keys b-1, b and b+1 and folded in one aggregation (no self-joins).
    slices = nodes.groupBy("_fk", "_b", "_s").agg(F.min("_node").alias("_mn"), F.max("_t").alias("_mx"))
    stats = slices.groupBy("_fk", "_b").agg(F.min("_mn").alias("_mn"), F.max("_mx").alias("_mx"),
                                            F.collect_list(F.struct("_s", "_mn")).alias("_slices"))
    role = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("_role")
    spread_stats = stats.select("_fk", "_b", "_mn", "_mx", "_slices", role) \
        .withColumn("_key", c("_b") - c("_role"))
    pick = lambda r, col: F.max(F.when(c("_role") == r, c(col)))
    look = materialize(
        spread_stats.groupBy("_fk", c("_key").alias("_b"))
        .agg(pick(0, "_mn").alias("_min1"), pick(0, "_mx").alias("_max1"),
             pick(-1, "_mx").alias("_pmax"), pick(1, "_mn").alias("_min2"), pick(0, "_slices").alias("_slices"))
        .select("_fk", "_b", "_min1", "_min2", "_slices",
                (c("_min1").isNotNull()
                 & (c("_pmax").isNull() | (c("_min1._t") - c("_pmax") >= w))).alias("_st1"),
                (c("_min2").isNotNull()
                 & (c("_max1").isNull() | (c("_min2._t") - c("_max1") >= w))).alias("_st2")))

    # As-of inside one slice: first node >= t + W, via a running min in
    # descending order (nodes sort before queries on equal values).
    node_rows = nodes.select("_fk", "_b", "_s", c("_t").alias("_v"), F.lit(0).alias("_kind"), "_node",
                             F.lit(None).cast("long").alias("_src"))
    query_rows = nodes.select("_fk", (c("_b") + 1).alias("_b"), "_s", (c("_t") + w).alias("_v"),
                              F.lit(1).alias("_kind"), F.lit(None).cast(nodes.schema["_node"].dataType)
                              .alias("_node"), c("_rep").alias("_src"))
    asof = Window.partitionBy("_fk", "_b", "_s").orderBy(c("_v").desc(), c("_kind").asc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cand = (node_rows.unionByName(query_rows)
            .withColumn("_in", F.min("_node").over(asof))
            .where(c("_kind") == 1))
    # Slices behind the query's own, if it has no later node.
    later = F.array_min(F.transform(F.filter("_slices", lambda x: x["_s"] > c("_s")), lambda x: x["_mn"]))
    nxt = (F.when(c("_cand").isNotNull(),
                  F.when((c("_cand._t") == c("_min1._t")) & c("_st1"), F.lit(None).cast("long"))
                  .otherwise(c("_cand._rep")))
           .otherwise(F.when(c("_min2").isNotNull() & ~F.coalesce(c("_st2"), F.lit(True)),
                             c("_min2._rep"))))
    jump, live = materialize_counted(
        cand.join(look, ["_fk", "_b"], "left").withColumn("_cand", F.coalesce("_in", later))
        .select(c("_src").alias("_rep"), nxt.alias("_n"))
        .where(c("_n").isNotNull()))

    # Pointer doubling on node ids: levels[k] holds the 2^k-th successors.
    levels = []
    while live > 0:
        if live > LEVEL_BROADCAST_MAX:
            jump = jump.hint("merge")
        levels.append(jump)
        right = jump.select(c("_rep").alias("_m"), c("_n").alias("_n2"))
        jump, live = materialize_counted(
            jump.join(right, c("_n") == c("_m")).select("_rep", c("_n2").alias("_n")))

    # Expansion from the session starts covers chain positions [0, 2^K): per
    # level one left join emits each node and its 2^k-th successor, so every
    # level reads the previous set once and the lineage stays linear.
    kept = look.where(c("_st1")).select(c("_min1._rep").alias("_rep"))
    for level in reversed(levels):
        kept = (kept.join(level, "_rep", "left")
                .select(F.explode(F.array_compact(F.array(c("_rep"), c("_n")))).alias("_rep")))
    return kept, len(levels)
