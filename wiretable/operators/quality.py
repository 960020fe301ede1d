"""Validation with quarantine.

The reference removes rows phase by phase and counts each phase.  Here one
``CASE`` charges each row to the *first* test it fails, in the same order
(required -> address -> port -> timestamp -> protocol), so every counter comes
from one grouped count and the rejects are kept as a quarantine table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fields as X
from ..functions.addresses import is_valid_ip
from ..schema import REQUIRED_COLUMNS, Profile, profile as _profile
from ..session import bind

#: Reject reasons in the order of the tests.
REASONS = ["missing_required", "invalid_ip", "invalid_port", "invalid_timestamp", "invalid_protocol"]

def with_reject_reason(df: DataFrame, prof: str | Profile) -> DataFrame:
    """Adds typed columns and ``reject_reason`` (NULL = passes every test).

    Added: ``event_time`` (parsed wall clock), ``event_ns`` (exact ns for the
    flow window), ``src_port_n``/``dst_port_n``/``length_n`` (typed values).
    """
    prof = _profile(prof)
    c = F.col
    modular = prof.name == "modular"
    text = X.time_text_modular(c("timestamp")) if modular else X.time_text_integrated(c("timestamp"))
    proto_ok = (X.protocol_whitelisted_modular if modular else X.protocol_whitelisted_integrated)(c("protocol"))
    missing = None
    for name in REQUIRED_COLUMNS:
        m = X.is_missing(c(name))
        missing = m if missing is None else missing | m

    # Each layer is bound once per row, so no format or pattern is tried twice.
    staged = bind(df, _tt=text, _ip_ok=is_valid_ip(c("src_ip")) & is_valid_ip(c("dst_ip")),
                  _sp=X.port_number(c("src_port")), _dp=X.port_number(c("dst_port")),
                  length_n=F.trim(c("length")).try_cast("double").try_cast("int"))
    staged = bind(staged, _tf=X.squash_blanks(c("_tt")),
                  _port_ok=X.port_is_valid(c("src_port"), modular, c("_sp")) & X.port_is_valid(c("dst_port"), modular, c("_dp")),
                  src_port_n=X.port_value(c("src_port"), c("_sp")), dst_port_n=X.port_value(c("dst_port"), c("_dp")))
    parsed = X.parse_by_signs(c("_tf"), X.FLEX_FORMATS)
    if modular:  # the validator's own list sees only what the generic parser leaves
        staged = bind(staged, _t1=parsed)
        staged = bind(staged, _tp=F.when(c("_t1").isNull(), X.cut_fraction(c("_tt"))))
        parsed = F.coalesce(c("_t1"), X.parse_by_signs(c("_tp"), X.MODULAR_FORMATS))
    staged = bind(staged, event_time=parsed)
    staged = bind(staged, event_ns=X.time_ns_from(c("event_time"), X.fraction_digits(c("_tt"))))
    # The integrated profile refuses a time beyond nanoseconds; the modular one keeps it without an instant.
    known = c("event_time") if modular else c("event_ns")
    reason = (
        F.when(missing, "missing_required")
        .when(~c("_ip_ok"), "invalid_ip")
        .when(~c("_port_ok"), "invalid_port")
        .when(known.isNull(), "invalid_timestamp")
        .when(~proto_ok, "invalid_protocol")
    )
    return bind(staged, reject_reason=reason).drop("_tt", "_tp", "_tf", "_t1", "_sp", "_dp", "_ip_ok", "_port_ok")


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passing rows, quarantined rows with their reason)."""
    return (df.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            df.where(F.col("reject_reason").isNotNull()))
