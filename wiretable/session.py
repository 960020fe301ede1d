"""Session helpers: the engine's expectations of a SparkSession.

The engine treats capture timestamps as naive wall-clock values (the zone
suffix is removed, not applied), so every plan is built with the session
time zone pinned to UTC.  Iterative operators cut their lineage with
``DataFrame.checkpoint``; the checkpoint folder comes from the session
(``spark.checkpoint.dir``) and is only invented for local runs.
"""

from __future__ import annotations

import contextvars
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UTC = "UTC"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "wiretable", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs (no UI, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Sets the session zone to UTC, for the caller's session too.

    Capture times are naive wall clock; plans are analysed with the session
    zone, so it is pinned before they are built and stays so afterwards.
    """
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it from the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; a
    machine-local temporary folder is only created when the master is local
    and nothing is configured (tests, bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative operators need a shared "
                "checkpoint folder on a cluster")
        configured = tempfile.mkdtemp(prefix="wiretable-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


_WORKSPACE: contextvars.ContextVar = contextvars.ContextVar("wiretable_workspace", default=None)


def _session_folder(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/wiretable/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Workspace:
    """Owner of the intermediate tables of one run.

    Tables materialised inside ``with workspace:`` lie in its folder, which
    ``close`` removes; results that read them must be written before.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{_session_folder(spark)}/{uuid.uuid4().hex}"

    def __enter__(self) -> Workspace:
        self._token = _WORKSPACE.set(self)
        return self

    def __exit__(self, *error) -> None:
        _WORKSPACE.reset(self._token)

    def close(self) -> None:
        _delete(self.spark, self.folder)


def new_folder(spark: SparkSession) -> str:
    """A folder for one intermediate table, inside the current workspace if there is one."""
    owner = _WORKSPACE.get()
    folder = owner.folder if owner else f"{_session_folder(spark)}/shared"
    return f"{folder}/{uuid.uuid4().hex}"


def clear_intermediate(spark: SparkSession) -> None:
    """Removes every intermediate table that this session has written."""
    _delete(spark, _session_folder(spark))


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint as a written table in the checkpoint folder.

    The rows are written once as Parquet under ``spark.checkpoint.dir`` and
    read back: lineage is cut, the data survives executor loss, and later
    reads get column pruning and filter pushdown.  (``Dataset.checkpoint`` on
    an unpersisted plan would compute it twice: once to count, once to write.)
    """
    return materialize_counted(df)[0]


def materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``materialize`` plus the number of rows written, observed during the
    write (no second pass)."""
    out, seen = materialize_observed(df, rows=F.count(F.lit(1)))
    return out, int(seen["rows"])


def materialize_observed(df: DataFrame, **metrics) -> tuple[DataFrame, dict]:
    """``materialize`` plus aggregate metrics (name -> Column) computed while
    the rows are written."""
    from pyspark.sql import Observation

    spark = df.sparkSession
    path = new_folder(spark)
    seen = Observation()
    df.observe(seen, *[col.alias(name) for name, col in metrics.items()]).write.mode("error").parquet(path)
    return spark.read.parquet(path), dict(seen.get)


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns whose values are computed once per row.

    ``inline(array(struct(...)))`` gives exactly one row; expressions above are
    not pushed below it, so a filter or a later column reads the values instead
    of repeating their expressions.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
