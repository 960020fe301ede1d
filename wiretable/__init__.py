"""wiretable — a PySpark-native engine for packet-capture datasets.

Typical use::

    from wiretable import build_session, read_export, run
    spark = build_session()
    raw = read_export(spark, "/data/exports", "integrated", glob="*.tsv")
    result = run(raw, "integrated", salt="<secret>")
    result.anonymised.write.parquet("/data/clean")

Subpackages: ``functions`` (column expressions and fixed rule values),
``sources`` (export readers, packet view), ``operators`` (validation, signals,
de-duplication, pseudonymisation, reports, profiling), ``plans`` (pipelines,
table load, query registry and oracles), ``streaming`` (incremental ingest).
"""

from .plans.pipeline import clean, extract, run, validate
from .schema import INTEGRATED, MODULAR, PROFILES, Profile
from .session import build_session
from .sources.exports import list_exports, read_export

__all__ = ["INTEGRATED", "MODULAR", "PROFILES", "Profile", "build_session", "clean", "extract",
           "list_exports", "read_export", "run", "validate"]
__version__ = "0.1.0"
