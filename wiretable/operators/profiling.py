"""Profiling metrics as DataFrames.

Each report is one aggregation (or one grouped aggregation) over all rows;
the reference computed the same figures with one pandas pass per number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fields as X


def distinct_endpoints(df: DataFrame, src: str = "src_ip", dst: str = "dst_ip",
                       approximate: bool = False) -> DataFrame:
    """Distinct sources and destinations (G1); HyperLogLog++ when approximate."""
    f = (lambda c: F.approx_count_distinct(c, 0.01)) if approximate else F.count_distinct
    return df.agg(f(src).alias("distinct_src"), f(dst).alias("distinct_dst"))


def distinct_per_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Distinct ``value`` per ``group``."""
    return df.groupBy(group).agg(F.count_distinct(value).alias(f"distinct_{value}"))


def value_distribution(df: DataFrame, column: str = "protocol", top: int | None = None) -> DataFrame:
    """Counts per value, descending."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), F.asc_nulls_first(column))
    return out.limit(top) if top else out


def value_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """min/max per column (G4), as (column, min, max) rows of text."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).cast("string").alias(f"{c}__min"), F.max(c).cast("string").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__min").alias("min_value"),
                 F.col(f"{c}__max").alias("max_value")) for c in columns])).alias("r")).select("r.*")


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null, empty and non-null counts and the non-null share per column."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in columns:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
                 F.count_if(F.col(c) == "").alias(f"{c}__empty")]
    wide = df.agg(*aggs)
    rows = F.col("__rows")
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.col(f"{c}__nulls").alias("nulls"),
                 F.col(f"{c}__empty").alias("empty"),
                 (rows - F.col(f"{c}__nulls")).alias("non_null"),
                 F.when(rows > 0, F.expr(f"((__rows - `{c}__nulls`) * 2000 + __rows) div (__rows * 2)") / 10)
                 .alias("non_null_pct"))
        for c in columns])).alias("r")).select("r.*")


def extraction_stats(tagged: DataFrame) -> DataFrame:
    """Per file and overall: total, kept, filtered, filtered %.

    ``rollup`` yields the per-file rows and the grand total in one job.
    """
    out = (tagged.rollup("source_file")
           .agg(F.count(F.lit(1)).alias("total"),
                F.count_if(F.col("extract_outcome") == "kept").alias("kept"))
           .withColumn("filtered", F.col("total") - F.col("kept"))
           .withColumn("filtered_pct",
                       F.expr("(filtered * 20000 + total) div (total * 2)") / 100)
           .withColumn("source_file", F.coalesce("source_file", F.lit("__all__"))))
    return out


def outcome_counts(tagged: DataFrame) -> DataFrame:
    """Rows per file and extraction outcome."""
    return tagged.groupBy("source_file", "extract_outcome").agg(F.count(F.lit(1)).alias("rows"))


def file_outcomes(listing: DataFrame, tagged: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Outcome of every listed file (G9): processed, no_data or failed.

    A file that gave rows is processed; one without rows (only a header, or
    empty) has no data; ``failed`` names the files whose capture could not be
    exported (``source_file``), which the decoding tool reports.
    """
    produced = tagged.select("source_file").distinct().withColumn("_seen", F.lit(True))
    out = listing.select("source_file").join(produced, "source_file", "left")
    if failed is not None:
        out = out.join(failed.select("source_file").distinct().withColumn("_failed", F.lit(True)), "source_file", "full")
    else:
        out = out.withColumn("_failed", F.lit(None).cast("boolean"))
    return out.select("source_file", F.when(F.col("_failed"), "failed").when(F.col("_seen"), "processed")
                      .otherwise("no_data").alias("outcome"))


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``count_if`` of missing (null or empty) per column, one row."""
    return df.agg(*[F.count_if(X.is_missing(F.col(c))).alias(f"{c}_missing") for c in columns])
