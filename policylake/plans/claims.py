"""Clean claim table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands, dates, numbers, text
from ..functions.steps import apply_steps
from ..operators.dedupe import keep_first
from ..operators.schema import column_types, normalize_headers, require_column, with_optional
from .bounds import Bounds, clip_bounds, clip_columns, learned

KEYS = ("claim_id", "contract_id", "client_id", "vehicle_id")
OPENED, CLOSED = "date_sinistre_claim", "date_cloture_claim"
ESTIMATE, PAYOUT = "montant_estime_dommage_claim", "montant_indemnisation_claim"
AMOUNTS = (ESTIMATE, PAYOUT)
DAYS, HOURS, SLA = "duree_traitement_jours", "duree_traitement_heures", "sla_jours"


def parse_claims(raw: DataFrame) -> DataFrame:
    """Typed columns within their ranges, durations taken from the dates where both are known."""
    df = normalize_headers(raw)
    for key in KEYS:
        df = require_column(df, key)
    df = with_optional(df, {c: ("timestamp_ntz", None) for c in (OPENED, CLOSED)})
    df = with_optional(df, {c: ("double", None) for c in (SLA, DAYS, HOURS)})
    types = column_types(df)
    rules = {c: text.normalized_id(types[c]) for c in KEYS}
    rules |= {c: dates.parsed_timestamp(types[c]) for c in (OPENED, CLOSED)}
    for c, rule in (
        ("type_sinistre_claim", text.clean_text),
        ("statut_sinistre_claim", text.claim_status),
        ("description_sinistre_claim", text.collapsed_text),
        ("est_frauduleux_claim", numbers.flag_number),
        ("incoherence_dommages", numbers.flag),
        ("nature_sinistre_consistante", numbers.flag),
        ("is_delayed", numbers.flag_number),
    ):
        if c in types:
            rules[c] = rule(types[c])
    for c in (*AMOUNTS, SLA, DAYS, HOURS):
        if c in types:
            rules[c] = (*numbers.strict_number(types[c]), numbers.within(0))
    return with_durations(apply_steps(df, rules))


def with_durations(df: DataFrame) -> DataFrame:
    """Handling time from opening to closing where both are known, else the supplied one."""
    known = F.col(OPENED).isNotNull() & F.col(CLOSED).isNotNull()
    df = df.withColumn("__hours", F.when(known, dates.elapsed_hours(F.col(OPENED), F.col(CLOSED))))
    hours = F.when(F.col("__hours") >= 0, F.col("__hours"))
    return df.withColumns({
        DAYS: F.when(F.col("__hours").isNull(), F.col(DAYS)).otherwise(hours / F.lit(24.0)),
        HOURS: F.when(F.col("__hours").isNull(), F.col(HOURS)).otherwise(hours),
    }).drop("__hours")


def delay_label(unknown: int | None = 0) -> Column:
    """1 where the handling took longer than agreed; ``unknown`` where that cannot be told."""
    late = (F.col(DAYS) > F.col(SLA)).cast("bigint")
    return F.coalesce(late, F.lit(unknown).cast("bigint"))


def with_gap(df: DataFrame) -> DataFrame:
    """Payout minus estimate, and its share of the estimate."""
    gap = F.col(PAYOUT) - F.col(ESTIMATE)
    return df.withColumns({"claim_gap_amount": gap, "claim_gap_ratio": numbers.ratio(gap, F.col(ESTIMATE))})


def _with_features(parsed: DataFrame, bounds: Bounds) -> DataFrame:
    df = clip_columns(parsed, bounds, AMOUNTS)
    return with_gap(df) if {PAYOUT, ESTIMATE} <= set(df.columns) else df


def claim_bounds(parsed: DataFrame) -> Bounds:
    bounds = clip_bounds(parsed, AMOUNTS, {"claim_severity_bucket": (PAYOUT, bands.SEVERITY_QUANTILES)})
    df = _with_features(parsed, bounds)
    return bounds | (clip_bounds(df, ["claim_gap_ratio"]) if "claim_gap_ratio" in df.columns else {})


DERIVED = ("is_delayed", "claim_gap_amount", "claim_gap_ratio", "claim_severity_bucket")


def clean_claims(
    raw: DataFrame,
    bounds: Bounds | None = None,
    order_by: Sequence[str] = (),
    unknown_label: int | None = 0,
) -> DataFrame:
    """One row per claim with capped amounts, durations, delay label, gap and severity.

    Rows equal in all other columns are equal in the derived ones too. So these are made for the rows kept, unless the order names them or
    the source has columns of their names.
    """
    df, bounds = learned(parse_claims(raw), claim_bounds, bounds, "claims")
    df = df.filter(F.col("claim_id").isNotNull())
    late = not set(DERIVED) & {*order_by, *df.columns}
    if late:
        df = keep_first(clip_columns(df, bounds, AMOUNTS), "claim_id", order_by, hashed=True)
    if "is_delayed" not in df.columns:
        df = df.withColumn("is_delayed", delay_label(unknown_label))
    df = clip_columns(_with_features(df, bounds), bounds, ["claim_gap_ratio"])
    if PAYOUT in df.columns:
        severity = bands.band(F.col(PAYOUT), bounds["claim_severity_bucket"], bands.SEVERITY_LABELS)
        df = df.withColumn("claim_severity_bucket", severity)
    return df if late else keep_first(df, "claim_id", order_by, hashed=True)
