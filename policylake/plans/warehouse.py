"""Star schema and the wide claim table for learning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numbers
from ..operators.dedupe import keep_first
from ..operators.lookup import lookup
from ..operators.quantiles import quantiles
from ..operators.schema import keep_columns
from .bounds import CLIP_QUANTILES, Bounds, clipped
from .claims import CLOSED, DAYS, HOURS, OPENED, PAYOUT, SLA

# Columns of the dimension tables.
DIM_CLIENT = (
    "client_id", "nom", "prenom", "genre", "age", "age_group",
    "niveau_professionnel", "revenu_annuel", "income_band",
    "score_credit", "credit_band",
    "gouvernorat", "ville",
    "driving_risk_score", "financial_stress_score", "responsible_behavior_score",
    "risque_comportemental", "risque_rse", "risque_financier", "risque_fraude", "risque_global",
)
DIM_POLICY = (
    "contract_id", "client_id",
    "date_debut_contrat", "date_fin_contrat",
    "type_couverture",
    "prime_assurance_annuelle",
    "nb_sinistres_precedents",
    "delai_souscription_sinistre_jours",
    "policy_duration_days", "policy_tenure_bucket",
)
DIM_VEHICLE = (
    "vehicle_id", "contract_id",
    "type_vehicule", "marque", "modele",
    "annee_modele", "vehicle_age",
    "puissance_fiscale",
    "kilometrage_actuel", "mileage_per_year",
    "valeur_vehicule", "vehicle_value_band",
    "usage_vehicule",
)

# Attributes that the fact table takes over.
FACT_POLICY = (
    "type_couverture", "prime_assurance_annuelle",
    "nb_sinistres_precedents", "delai_souscription_sinistre_jours",
    "policy_duration_days", "policy_tenure_bucket",
)
FACT_CLIENT = ("risque_global", "driving_risk_score", "financial_stress_score", "responsible_behavior_score")
FACT_VEHICLE = (
    "vehicle_age", "valeur_vehicule", "mileage_per_year",
    "vehicle_value_band", "usage_vehicule", "type_vehicule",
)
FACT_DROPPED = (CLOSED, "close_date_key", DAYS, HOURS, SLA, "is_delayed")

# Attributes that the learning table takes over.
ML_POLICY = (
    "type_couverture",
    "prime_assurance_annuelle",
    "nb_sinistres_precedents",
    "delai_souscription_sinistre_jours",
    "policy_duration_days",
    "policy_tenure_bucket",
    "date_debut_contrat",
)
ML_CLIENT = (
    "age", "age_group", "genre",
    "revenu_annuel", "income_band",
    "score_credit", "credit_band",
    "nb_retards_paiement", "nb_infractions_majeures", "points_permis_retires",
    "driving_risk_score", "financial_stress_score", "responsible_behavior_score",
    "risque_comportemental", "risque_rse", "risque_financier", "risque_fraude", "risque_global",
    "changement_frequent_assureur",
    "nombre_enfants",
)
ML_VEHICLE = (
    "type_vehicule", "marque", "modele", "usage_vehicule",
    "vehicle_age", "valeur_vehicule", "vehicle_value_band",
    "kilometrage_actuel", "mileage_per_year", "puissance_fiscale",
)
ML_DROPPED = (CLOSED, DAYS, HOURS, "description_sinistre_claim")

POLICY, CLIENT, VEHICLE = "policy__", "client__", "vehicle__"
FACT_CLIENT_ID = "fact__client_id"


def dimension(clean: DataFrame, columns: Sequence[str], unique: bool = False) -> DataFrame:
    """The listed columns, one row per key (the first column)."""
    dim = keep_columns(clean, columns)
    return dim if unique else keep_first(dim, columns[0])


def dim_client(clients: DataFrame, unique: bool = False) -> DataFrame:
    return dimension(clients, DIM_CLIENT, unique)


def dim_policy(policies: DataFrame, unique: bool = False) -> DataFrame:
    return dimension(policies, DIM_POLICY, unique)


def dim_vehicle(vehicles: DataFrame, unique: bool = False) -> DataFrame:
    return dimension(vehicles, DIM_VEHICLE, unique)


def dim_time(policies: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per calendar day seen in the policies and claims."""
    def days(df: DataFrame, names: Sequence[str]) -> DataFrame | None:
        present = [F.to_date(F.col(n)) for n in names if n in df.columns]
        if not present:
            return None
        return df.select(F.explode(F.array(*present)).alias("full_date")).filter("full_date is not null").distinct()

    found = [days(policies, ("date_debut_contrat", "date_fin_contrat")), days(claims, (OPENED, CLOSED))]
    found = [d for d in found if d is not None]
    if not found:
        found = [policies.select(F.lit(None).cast("date").alias("full_date")).filter(F.lit(False))]
    every = found[0] if len(found) == 1 else found[0].unionAll(found[1]).distinct()
    day = F.col("full_date")
    return every.select(
        day,
        dates.date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
    )


def _prefixed(df: DataFrame, key: str, names: Sequence[str], prefix: str) -> DataFrame:
    kept = dict.fromkeys(n for n in names if n in df.columns and n != key)
    return df.select(key, *[F.col(n).alias(prefix + n) for n in kept])


def claim_wide(
    claims: DataFrame, policies: DataFrame, clients: DataFrame, vehicles: DataFrame, unique: bool = True
) -> DataFrame:
    """Claims with every policy, client and vehicle attribute that the fact and learning tables need.

    Three lookups serve both tables. The client is found by the claim's own client id, else by
    the policy's; the learning table, which knows the claim's id only, blanks the second kind.
    """
    pol = _prefixed(policies, "contract_id", ("client_id", *ML_POLICY), POLICY)
    cli = _prefixed(clients, "client_id", (*ML_CLIENT, *FACT_CLIENT), CLIENT)
    cli = cli.withColumnRenamed("client_id", FACT_CLIENT_ID)
    veh = _prefixed(vehicles, "vehicle_id", (*ML_VEHICLE, *FACT_VEHICLE), VEHICLE)
    wide = lookup(claims, pol, "contract_id", pol.columns, unique)
    wide = wide.withColumn(FACT_CLIENT_ID, F.coalesce("client_id", POLICY + "client_id"))
    wide = lookup(wide, cli, FACT_CLIENT_ID, cli.columns, unique)
    return lookup(wide, veh, "vehicle_id", veh.columns, unique)


def _claim_columns(wide: DataFrame) -> dict[str, Column]:
    added = (POLICY, CLIENT, VEHICLE)
    return {c: F.col(c) for c in wide.columns if not c.startswith(added) and c != FACT_CLIENT_ID}


def _attach(have: dict[str, Column], wide: DataFrame, names: Sequence[str], prefix: str, own_only: bool = False) -> dict[str, Column]:
    """Add attributes; a name on both sides becomes ``_x`` (claim) and ``_y`` (attribute)."""
    new = [n for n in names if prefix + n in wide.columns]
    out = {f"{n}_x" if n in new else n: c for n, c in have.items()}
    for n in new:
        value = F.col(prefix + n)
        if own_only:
            value = F.when(F.col("client_id").isNotNull(), value)
        out[f"{n}_y" if n in have else n] = value
    return out


RATIOS = {
    "loss_ratio": (PAYOUT, POLICY + "prime_assurance_annuelle"),
    "premium_to_value_ratio": (POLICY + "prime_assurance_annuelle", VEHICLE + "valeur_vehicule"),
}


def wide_bounds(wide: DataFrame, ratios: Sequence[str] = tuple(RATIOS)) -> Bounds:
    """Clip ends of the ratios whose columns exist, all in the same passes."""
    present = {n: RATIOS[n] for n in ratios if set(RATIOS[n]) <= set(wide.columns)}
    return quantiles(wide, {n: (numbers.ratio(F.col(a), F.col(b)), CLIP_QUANTILES) for n, (a, b) in present.items()})


def fact_bounds(wide: DataFrame) -> Bounds:
    return wide_bounds(wide, ["loss_ratio"])


def _loss_ratio() -> Column:
    return numbers.ratio(F.col(PAYOUT), F.col(POLICY + "prime_assurance_annuelle"))


def fact_claim(wide: DataFrame, bounds: Bounds | None = None) -> DataFrame:
    """Claim fact: claim columns, attributes, day key and capped loss ratio."""
    bounds = fact_bounds(wide) if bounds is None else bounds
    out = _attach(_claim_columns(wide), wide, FACT_POLICY, POLICY)
    out.pop("client_id")
    out["client_id"] = F.col(FACT_CLIENT_ID)
    out = _attach(out, wide, FACT_CLIENT, CLIENT)
    out = _attach(out, wide, FACT_VEHICLE, VEHICLE)
    if OPENED in out:
        out["date_key"] = dates.date_key(F.col(OPENED)).cast("bigint")
    if "loss_ratio" in bounds:
        out["loss_ratio"] = clipped(bounds, "loss_ratio", _loss_ratio())
    return wide.select(*[c.alias(n) for n, c in out.items() if n not in FACT_DROPPED])


def ml_bounds(wide: DataFrame) -> Bounds:
    return wide_bounds(wide, ["premium_to_value_ratio"])


def _premium_to_value() -> Column:
    return numbers.ratio(F.col(POLICY + "prime_assurance_annuelle"), F.col(VEHICLE + "valeur_vehicule"))


def ml_claim(wide: DataFrame, bounds: Bounds | None = None, strict_opening: bool = False) -> DataFrame:
    """Wide learning table: claim columns, attributes, premium/value ratio and date parts.

    ``strict_opening`` also drops the payout, its derivatives and the status, which are not
    known yet when a claim is opened.
    """
    bounds = ml_bounds(wide) if bounds is None else bounds
    out = _claim_columns(wide)
    out.setdefault("is_delayed", F.lit(None).cast("bigint"))
    out.setdefault("statut_sinistre_claim", F.lit("Unknown"))
    out = _attach(out, wide, ML_POLICY, POLICY)
    out = _attach(out, wide, ML_CLIENT, CLIENT, own_only=True)
    out = _attach(out, wide, ML_VEHICLE, VEHICLE)
    if "premium_to_value_ratio" in bounds:
        out["premium_to_value_ratio"] = clipped(bounds, "premium_to_value_ratio", _premium_to_value())
    if OPENED in out:
        out |= dates.claim_date_parts(F.col(OPENED))
    dropped = set(ML_DROPPED)
    if strict_opening:
        dropped |= {PAYOUT, "claim_gap_amount", "claim_gap_ratio", "claim_severity_bucket", "statut_sinistre_claim"}
    return wide.select(*[c.alias(n) for n, c in out.items() if n not in dropped])
