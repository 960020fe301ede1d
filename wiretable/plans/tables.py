"""Sinks and table management (K1-K9).

The analysed table is a managed Parquet table.  Its layout replaces the
reference's B-tree indexes: date partitions (partition pruning on time),
rows sorted by destination/source/protocol inside each file (Parquet min/max
statistics then skip row groups), and a Parquet bloom filter on
``dns_query`` (point lookups).  Loads overwrite by default; append is opt-in
because appending the same rows twice doubles every count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..schema import Profile, profile as _profile


def write_stage(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A stage between runs: Parquet, or UTF-8 CSV with header (K1)."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def with_load_columns(df: DataFrame, first_id: int = 0) -> DataFrame:
    """Surrogate ``id`` from ``first_id`` on (unique, not dense) and ``created_at`` (K5)."""
    return (df.withColumn("id", F.monotonically_increasing_id() + F.lit(first_id).cast("bigint"))
            .withColumn("created_at", F.current_timestamp()))


def assert_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NOT NULL contract (K4) enforced while writing: a violating row fails the job.

    The test stands in the column itself, so it cannot be pruned as unused.
    """
    def checked(name: str) -> Column:
        broken = X.is_missing(F.col(name).cast("string"))
        return F.when(broken, F.raise_error(F.lit(f"NOT NULL violated on {name}"))).otherwise(F.col(name))

    return df.withColumns({c: checked(c) for c in columns})


def write_table(df: DataFrame, name: str, prof: str | Profile, mode: str = "overwrite", path: str | None = None,
                partition_col: str | None = "event_time", bloom_col: str | None = "dns_query") -> int:
    """Load ``df`` into table ``name`` and check the count (K2-K7).

    The profile gives the NOT NULL columns and the sort order inside files;
    ``df`` has to have them.  Rows are rebalanced on the date, so a date's files
    have the size that AQE aims at: small dates share a task, a hot date is
    split.  Appended ids go on behind the table's largest.  Returns the number of
    rows loaded; raises when the table holds another number than the source.
    """
    from pyspark.sql import Observation

    prof = _profile(prof)
    spark = df.sparkSession
    absent = [c for c in {*prof.not_null, *prof.layout} if c not in df.columns]
    if absent:
        raise ValueError(f"no columns {sorted(absent)} for profile {prof.name}")
    before, first_id = 0, 0
    if mode == "append" and spark.catalog.tableExists(name):
        held = spark.table(name).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("id")).first()
        before, first_id = held["n"], (held["id"] if held["id"] is not None else -1) + 1
    seen = Observation("load")
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_col and partition_col in out.columns:
        out = out.withColumn("event_date", F.to_date(F.col(partition_col))).hint("rebalance", "event_date")
    out = assert_not_null(with_load_columns(out, first_id), prof.not_null)
    if "event_date" in out.columns:
        writer = out.sortWithinPartitions("event_date", *prof.layout).write.partitionBy("event_date")
    else:
        writer = out.sortWithinPartitions(*prof.layout).write
    writer = writer.mode(mode).format("parquet")
    if bloom_col and bloom_col in out.columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{bloom_col}", "true")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    loaded = spark.table(name).count() - before
    source = seen.get["rows"]
    if loaded != source:
        source = df.count()  # a retried task is observed twice: count the source itself before refusing the load
    if loaded != source:
        raise AssertionError(f"load count mismatch: {source} rows read, {loaded} in table {name}")
    return loaded


def write_load(df: DataFrame, name: str, prof: str | Profile, load_id: str, partition_col: str = "event_time",
               key_col: str = "packet_id") -> int:
    """Adds a load to table ``name``; the same load again replaces itself (K2, K5, K7).

    The table is partitioned by load and date, and a load overwrites its own partitions
    only (dynamic partition overwrite); dates that it no longer has are dropped.  A row's
    id is its ``key_col`` (unique in a load) behind the load's first id, which a replay
    takes over, so a replayed load leaves rows and ids as they were.
    """
    prof = _profile(prof)
    spark = df.sparkSession
    absent = [c for c in {*prof.not_null, *prof.layout, partition_col, key_col} if c not in df.columns]
    if absent:
        raise ValueError(f"no columns {sorted(absent)} for profile {prof.name}")
    first_id, dates = 0, set()
    if spark.catalog.tableExists(name):
        held = spark.table(name)
        own = held.where(F.col("load_id") == load_id)
        first_id = own.agg(F.min(F.col("id") - F.col(key_col))).first()[0]
        if first_id is None:
            low = df.agg(F.min(key_col)).first()[0] or 0
            first_id = (held.agg(F.max("id")).first()[0] or -1) + 1 - min(low, 0)
        dates = {r[0] for r in own.select("event_date").distinct().collect()}  # one per date
    out = df.withColumns({"id": F.lit(first_id).cast("bigint") + F.col(key_col), "created_at": F.current_timestamp()})
    out = assert_not_null(out, prof.not_null).withColumns(
        {"load_id": F.lit(load_id), "event_date": F.to_date(F.col(partition_col))})
    out = out.hint("rebalance", "event_date").sortWithinPartitions("event_date", *prof.layout)
    if not spark.catalog.tableExists(name):
        out.write.partitionBy("load_id", "event_date").format("parquet").saveAsTable(name)
    else:
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            out.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
        finally:
            spark.conf.set(setting, before)
    now = spark.table(name).where(F.col("load_id") == load_id)
    if dates:
        for date in dates - {r[0] for r in df.select(F.to_date(F.col(partition_col))).distinct().collect()}:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (load_id = '{load_id}', event_date = '{date}')")
    loaded, source = now.count(), df.count()
    if loaded != source:
        raise AssertionError(f"load count mismatch: {source} rows read, {loaded} in load {load_id} of table {name}")
    return loaded


def load_checks(t: DataFrame, prof: str | Profile) -> DataFrame:
    """Row count, distinct endpoints and ids, and missing NOT NULL values of a loaded table (K7, K9)."""
    prof = _profile(prof)
    src, dst = prof.anon_columns
    missing = [X.is_missing(F.col(c).cast("string")) for c in prof.not_null]
    broken = missing[0]
    for m in missing[1:]:
        broken = broken | m
    return t.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(src).alias("distinct_src"),
                 F.count_distinct(dst).alias("distinct_dst"), F.count_distinct("id").alias("distinct_ids"),
                 F.count_if(broken).alias("broken_rows"))


def describe_table(spark: SparkSession, name: str, sample: int = 3) -> dict:
    """Existence, columns, count and a small sample (K8)."""
    if not spark.catalog.tableExists(name):
        return {"exists": False}
    t = spark.table(name)
    return {
        "exists": True,
        "columns": [(c.name, c.dataType) for c in spark.catalog.listColumns(name)],
        "rows": t.count(),
        "sample": [r.asDict() for r in t.limit(sample).collect()],
    }
