"""Clean policy table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands, dates, numbers, text
from ..functions.steps import apply_steps
from ..operators.dedupe import keep_first
from ..operators.schema import column_types, normalize_headers, require_column, with_optional
from .bounds import Bounds, clip_bounds, clip_columns, learned

DATES = ("date_debut_contrat", "date_fin_contrat")
CLIPPED = ("prime_assurance_annuelle", "delai_souscription_sinistre_jours")


def parse_policies(raw: DataFrame) -> DataFrame:
    """Typed columns within their ranges; unknown columns pass through."""
    df = normalize_headers(raw)
    for key in ("contract_id", "client_id"):
        df = require_column(df, key)
    df = with_optional(df, {c: ("timestamp_ntz", None) for c in DATES})
    types = column_types(df)
    rules = {c: text.normalized_id(types[c]) for c in ("contract_id", "client_id")}
    rules |= {c: dates.parsed_timestamp(types[c]) for c in DATES}
    if "type_couverture" in types:
        rules["type_couverture"] = text.clean_text(types["type_couverture"])
    rules |= {c: (*numbers.strict_number(types[c]), numbers.within(0)) for c in CLIPPED if c in types}
    if "nb_sinistres_precedents" in types:
        rules["nb_sinistres_precedents"] = (
            *numbers.strict_number(types["nb_sinistres_precedents"]), numbers.within(), numbers.at_least_zero
        )
    return apply_steps(df, rules)


def policy_bounds(parsed: DataFrame) -> Bounds:
    return clip_bounds(parsed, CLIPPED)


def clean_policies(raw: DataFrame, bounds: Bounds | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per contract with capped numbers, duration and tenure."""
    df, bounds = learned(parse_policies(raw), policy_bounds, bounds, "policies")
    df = clip_columns(df, bounds, CLIPPED)
    df = df.withColumn("policy_duration_days", dates.elapsed_days(F.col(DATES[0]), F.col(DATES[1])))
    df = apply_steps(df, {"policy_duration_days": [numbers.within(0)]})
    df = df.withColumn("policy_tenure_bucket", bands.tenure_bucket(F.col("policy_duration_days")))
    return keep_first(df.filter(F.col("contract_id").isNotNull()), "contract_id", order_by)
