"""Small DataFrame helpers of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows written under ``spark.checkpoint.dir`` and read back."""
    from wiretable.session import materialize  # here, as tasks get this module without the library

    return materialize(df)


def stored_with(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stored``, and aggregates observed while the rows are written."""
    from wiretable.session import materialize_observed

    return materialize_observed(df, **metrics)


def bounded(df: DataFrame, small: DataFrame, on: str, how: str, max_rows: int = 1_000_000) -> DataFrame:
    """A join that broadcasts ``small`` only if it is measured small."""
    from wiretable.operators.joins import bounded_join

    return bounded_join(df, small, [on], how, max_rows)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, inside the owner's of the current run."""
    from wiretable.session import new_folder

    return new_folder(spark)


def keyed(df: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """Only id and text under fixed names; with ``carry`` the whole input row as struct ``row``.

    Other input columns can have any name: they are either left out or inside ``row``.
    """
    cols = [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    if carry:
        cols.append(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))
    return df.select(*cols)


def fold(column: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as 0."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % F.lit(folds), F.lit(0))


def sha(column: Column) -> Column:
    return F.sha2(column, 256)
