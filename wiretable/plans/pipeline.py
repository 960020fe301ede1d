"""End-to-end plans: extract -> clean -> pseudonymise -> load (both profiles).

Each stage is a lazy DataFrame transformation.  Reliable checkpoints sit only
where a result is read more than once: the checked table (clean rows and
quarantine), the node tables of the flow thinning and the loaded table.
Computed outcomes are bound once per row (``session.bind``), so filtering on
them needs no write.  Counters are observed while the checked table is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.anonymize import pseudonymize
from ..operators.dedup import drop_exact, thin_flows
from ..operators.normalize import normalize, presence_drop
from ..operators.quality import REASONS, split_rejects, with_reject_reason
from ..operators.relevance import with_relevance
from ..operators.signals import with_signals
from ..schema import EXTRACTED_COLUMNS, Profile, profile as _profile
from ..session import Workspace, bind, ensure_utc, materialize_observed

CLEAN_COLUMNS = ["packet_id", "source_file", "timestamp", "src_ip", "dst_ip", "protocol",
                 "src_port", "dst_port", "length", "dns_query", "http_host", "http_path",
                 "user_agent", "event_time", "event_ns", "signals", "is_attack_pattern"]


@dataclass
class ExtractResult:
    extracted: DataFrame     # rows kept by extraction (11 columns + lineage)
    tagged: DataFrame        # every exported row with its extraction outcome


@dataclass
class CleanResult:
    clean: DataFrame         # rows kept, typed, with signals
    rejects: DataFrame       # quarantined rows with reject_reason
    validated: DataFrame     # passing rows before de-duplication
    deduplicated: DataFrame  # passing rows after exact de-duplication
    counts: dict             # rows checked and rows per reject reason, observed while written


def extract(raw: DataFrame, prof: str | Profile, na: tuple[str, ...] = ()) -> ExtractResult:
    """Normalise an export and apply the extraction-time filters.

    ``integrated`` drops rows without addresses or time; ``modular`` runs the
    relevance cascade (its rule 1 is the address check).  ``na``: further
    spellings of a missing value.
    """
    prof = _profile(prof)
    df = normalize(raw, prof, na)
    if prof.relevance_filter:
        df = with_relevance(df)
        outcome = F.when(F.col("relevant"), "kept").otherwise(
            F.concat(F.lit("rule_"), F.col("relevance_rule").cast("string")))
        if "short_row" in df.columns:
            outcome = F.when(F.col("short_row"), "short_row").otherwise(outcome)
    else:
        outcome = F.when(presence_drop(df, prof), "missing_address_or_time").otherwise("kept")
    tagged = bind(df, extract_outcome=outcome)
    kept = tagged.where(F.col("extract_outcome") == "kept").select(
        "packet_id", "source_file", *EXTRACTED_COLUMNS)
    return ExtractResult(extracted=kept, tagged=tagged)


def _dedup_columns(prof: Profile) -> list[str]:
    time_col = "event_ns" if prof.name == "integrated" else "timestamp"
    return [time_col, "src_ip", "dst_ip", "protocol", "src_port", "dst_port", "length",
            "dns_query", "http_host", "http_path", "user_agent"]


def validate(extracted: DataFrame, prof: str | Profile,
             extra_signals: dict | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """Validation with quarantine and signals: (flagged passing rows, rejects, counts)."""
    prof = _profile(prof)
    ensure_utc(extracted.sparkSession)
    # The checked table is read more than once (passing rows, port scans, quarantine):
    # written once, and counted while it is written.
    checked, counts = materialize_observed(
        with_reject_reason(extracted, prof), initial=F.count(F.lit(1)),
        **{r: F.count_if(F.coalesce(F.col("reject_reason") == r, F.lit(False))) for r in REASONS})
    ok, rejects = split_rejects(checked)
    typed = (ok.drop("src_port", "dst_port", "length")
             .withColumnRenamed("src_port_n", "src_port")
             .withColumnRenamed("dst_port_n", "dst_port")
             .withColumnRenamed("length_n", "length"))
    # Signals read the typed columns under their *_n names.
    flagged = with_signals(
        typed.withColumn("src_port_n", F.col("src_port")).withColumn("dst_port_n", F.col("dst_port"))
        .withColumn("length_n", F.col("length")), prof, extra_signals)
    flagged = flagged.drop("src_port_n", "dst_port_n", "length_n").select(*CLEAN_COLUMNS)
    return flagged, rejects, counts


def clean(extracted: DataFrame, prof: str | Profile, keep_flagged: bool = False,
          extra_signals: dict | None = None) -> CleanResult:
    """Validate (quarantine), flag, de-duplicate exactly, thin flows.

    ``keep_flagged=True`` exempts rows with an attack signal from the flow
    thinning (the reference only counts them).  The flow thinning runs its
    iterative part eagerly (the number of doubling rounds depends on the data).
    """
    prof = _profile(prof)
    flagged, rejects, counts = validate(extracted, prof, extra_signals)
    exact = drop_exact(flagged, _dedup_columns(prof))   # lazy: counters and the keep_flagged branch
    # The thinning runs on the validated rows: exact duplicates share flow and
    # time, and the least packet_id of a (flow, time) node is always an exact-
    # dedup survivor, so it keeps the same packets without the extra shuffle.
    options = {"untimed_rows": "first" if prof.name == "modular" else "keep"}
    if keep_flagged:
        thinned = thin_flows(flagged.where(~F.col("is_attack_pattern")), prof.flow_key, "event_ns",
                             prof.flow_window_ns, **options)
        thinned = thinned.unionByName(exact.where(F.col("is_attack_pattern")))
    else:
        thinned = thin_flows(flagged, prof.flow_key, "event_ns", prof.flow_window_ns, **options)
    return CleanResult(clean=thinned, rejects=rejects, validated=flagged, deduplicated=exact, counts=counts)


def clean_counters(result: CleanResult, prof: str | Profile) -> DataFrame:
    """Removal counters and retention (G7) as one (counter, value) table of a few rows.

    The checked rows were counted while they were written; what is left is one
    aggregation over the validated rows, one distinct count and the kept rows.
    """
    prof = _profile(prof)
    seen = result.validated.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_attack_pattern").alias("a")).first()
    after_exact = result.validated.select(*_dedup_columns(prof)).distinct().count()
    final = result.clean.count()
    initial = int(result.counts["initial"])
    values = {"initial": initial,
              **{r: int(result.counts[r]) for r in REASONS if result.counts[r]},
              "attack_signals_seen": seen["a"], "validated": seen["n"], "after_exact": after_exact, "final": final,
              "exact_duplicates": seen["n"] - after_exact, "flow_duplicates": after_exact - final,
              "retention_pct": (final * 20000 + initial) // (initial * 2) / 100 if initial else None}
    rows = [(k, float(v) if v is not None else None) for k, v in values.items()]
    return result.validated.sparkSession.createDataFrame(rows, "counter string, value double")


def anonymise(clean_df: DataFrame, prof: str | Profile, salt: str) -> DataFrame:
    return pseudonymize(clean_df, prof, salt)


@dataclass
class PipelineResult:
    """Results of a run; they read its intermediate tables until ``close``."""

    extract: ExtractResult
    clean: CleanResult
    anonymised: DataFrame
    workspace: Workspace

    def close(self) -> None:
        """Removes the run's intermediate tables (write the results before)."""
        self.workspace.close()

    def __enter__(self) -> PipelineResult:
        return self

    def __exit__(self, *error) -> None:
        self.close()


def run(raw: DataFrame, prof: str | Profile, salt: str, keep_flagged: bool = False,
        na: tuple[str, ...] = ()) -> PipelineResult:
    """Whole pipeline over an export DataFrame (see ``sources.exports``)."""
    prof = _profile(prof)
    with Workspace(raw.sparkSession) as workspace:
        ex = extract(raw, prof, na)
        cr = clean(ex.extracted, prof, keep_flagged)
        return PipelineResult(extract=ex, clean=cr, anonymised=anonymise(cr.clean, prof, salt), workspace=workspace)
