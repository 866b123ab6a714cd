"""Clean client table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands, numbers, text
from ..functions.steps import apply_steps
from ..operators.dedupe import keep_first
from ..operators.schema import column_types, keep_columns, normalize_headers, require_column
from .bounds import Bounds, clip_bounds, clip_columns, learned

# Columns of the table, by how they are read.
NAMES = ("nom", "prenom", "gouvernorat", "ville", "niveau_professionnel")
COUNTS = (
    "nb_retards_paiement", "nb_infractions_majeures", "points_permis_retires",
    "incidents_paiement_assureur", "historique_dettes", "nombre_enfants", "num_contracts_target",
)
RISKS = ("risque_comportemental", "risque_rse", "risque_financier", "risque_fraude", "risque_global")
FLAGS = (
    "participe_conduite_responsable", "entretien_regulier", "vehicule_peu_polluant",
    "engagement_securite_routiere", "changement_frequent_assureur",
)
CLIPPED = ("revenu_annuel", "score_credit", *RISKS)
OUTPUT = (
    "client_id",
    "nom", "prenom", "genre", "age", "age_group",
    "niveau_professionnel", "revenu_annuel", "income_band",
    "score_credit", "credit_band",
    "gouvernorat", "ville",
    "nb_retards_paiement", "nb_infractions_majeures", "points_permis_retires",
    "participe_conduite_responsable", "entretien_regulier", "vehicule_peu_polluant",
    "engagement_securite_routiere", "changement_frequent_assureur",
    "incidents_paiement_assureur", "historique_dettes", "nombre_enfants",
    "driving_behavior", "num_contracts_target",
    "risque_comportemental", "risque_rse", "risque_financier", "risque_fraude", "risque_global",
    "driving_risk_score", "financial_stress_score", "responsible_behavior_score",
)


def parse_clients(raw: DataFrame) -> DataFrame:
    """Typed columns within their ranges; rows without a client id are dropped."""
    df = require_column(normalize_headers(raw), "client_id")
    types = column_types(df)

    def rules(names, rule, *more):
        return {c: (*rule(types[c]), *more) for c in names if c in types}

    df = apply_steps(df, {
        **rules(["client_id"], text.normalized_id),
        **rules(NAMES, text.name_text),
        **rules(["genre"], text.gender),
        **rules(["driving_behavior"], text.driving_behavior),
        **rules(["age"], numbers.flexible_number, numbers.within(16, 100)),
        **rules(["revenu_annuel"], numbers.flexible_number, numbers.within(0)),
        **rules(["score_credit"], numbers.flexible_number, numbers.within(0, 1000)),
        **rules(RISKS, numbers.flexible_number, numbers.within()),
        **rules(COUNTS, numbers.whole_count),
        **rules(FLAGS, numbers.flag_number),
    })
    return df.filter(F.col("client_id").isNotNull())


def client_bounds(parsed: DataFrame) -> Bounds:
    return clip_bounds(parsed, CLIPPED, {"income_band": ("revenu_annuel", bands.QUINTILES)})


def clean_clients(raw: DataFrame, bounds: Bounds | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per client with capped numbers, bands and scores."""
    df, bounds = learned(parse_clients(raw), client_bounds, bounds, "clients")
    df = clip_columns(df, bounds, CLIPPED)
    here = df.columns
    derived = {}
    if "age" in here:
        derived["age_group"] = bands.age_group(F.col("age"))
    if "revenu_annuel" in here:
        derived["income_band"] = bands.band(F.col("revenu_annuel"), bounds["income_band"], bands.QUINTILE_LABELS)
    if "score_credit" in here:
        derived["credit_band"] = bands.credit_band(F.col("score_credit"))

    def parts(weights: dict[str, float]):
        return [(F.col(c), w) for c, w in weights.items() if c in here]

    derived["driving_risk_score"] = numbers.weighted_score(
        parts({"nb_infractions_majeures": 1.0, "points_permis_retires": 10.0})
    )
    derived["financial_stress_score"] = numbers.weighted_score(
        parts({"nb_retards_paiement": 1.0, "incidents_paiement_assureur": 1.0, "historique_dettes": 1.0})
    )
    responsible = ("participe_conduite_responsable", "entretien_regulier", "engagement_securite_routiere")
    derived["responsible_behavior_score"] = numbers.flag_count([F.col(c) for c in responsible if c in here])
    df = df.withColumns(derived)
    extra = [c for c in order_by if c not in OUTPUT]
    df = df.select(*[c for c in OUTPUT if c in df.columns], *extra)
    return keep_columns(keep_first(df, "client_id", order_by), OUTPUT)
