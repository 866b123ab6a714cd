"""Clean vehicle table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands, numbers, text
from ..functions.steps import apply_steps
from ..operators.dedupe import keep_first
from ..operators.schema import column_types, normalize_headers, require_column
from .bounds import Bounds, clip_bounds, clip_columns, learned

# Plausible ranges.
FIRST_YEAR = 1970
MAX_AGE = 100
MAX_KM_PER_YEAR = 300_000
RANGES = {
    "puissance_fiscale": (0, 200),
    "kilometrage_actuel": (0, 3_000_000),
    "valeur_vehicule": (0, 50_000_000),
}
LABELS = ("type_vehicule", "marque", "modele", "usage_vehicule")


def parse_vehicles(raw: DataFrame, as_of: date | None = None) -> DataFrame:
    """Typed columns within their ranges and the vehicle age in the ``as_of`` year."""
    year = (as_of or date.today()).year
    df = normalize_headers(raw)
    for key in ("vehicle_id", "contract_id"):
        df = require_column(df, key)
    types = column_types(df)
    rules = {c: text.normalized_id(types[c]) for c in ("vehicle_id", "contract_id")}
    rules |= {c: text.clean_text(types[c]) for c in LABELS if c in types}
    if "immatriculation" in types:
        rules["immatriculation"] = text.plate(types["immatriculation"])
    ranges = {"annee_modele": (FIRST_YEAR, year + 1), **RANGES}
    rules |= {c: (*numbers.strict_number(types[c]), numbers.within(*ranges[c])) for c in ranges if c in types}
    df = apply_steps(df, rules)
    age = F.lit(None).cast("double")
    if "annee_modele" in types:
        age = F.lit(float(year)) - F.col("annee_modele")
    return apply_steps(df.withColumn("vehicle_age", age), {"vehicle_age": [numbers.within(0, MAX_AGE)]})


def _with_km_per_year(parsed: DataFrame, bounds: Bounds) -> DataFrame:
    """Yearly distance from the capped odometer reading."""
    km = F.lit(None).cast("double")
    if "kilometrage_actuel" in parsed.columns:
        km = numbers.ratio(F.col("kilometrage_actuel"), F.col("vehicle_age"))
    df = clip_columns(parsed, bounds, RANGES).withColumn("mileage_per_year", km)
    return apply_steps(df, {"mileage_per_year": [numbers.within(0, MAX_KM_PER_YEAR)]})


def vehicle_bounds(parsed: DataFrame) -> Bounds:
    bounds = clip_bounds(parsed, RANGES, {"vehicle_value_band": ("valeur_vehicule", bands.QUINTILES)})
    return bounds | clip_bounds(_with_km_per_year(parsed, bounds), ["mileage_per_year"])


def clean_vehicles(
    raw: DataFrame, bounds: Bounds | None = None, as_of: date | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """One row per vehicle with capped numbers, yearly distance and value band."""
    df, bounds = learned(parse_vehicles(raw, as_of), vehicle_bounds, bounds, "vehicles")
    df = clip_columns(_with_km_per_year(df, bounds), bounds, ["mileage_per_year"])
    if "valeur_vehicule" in df.columns:
        value_band = bands.band(F.col("valeur_vehicule"), bounds["vehicle_value_band"], bands.QUINTILE_LABELS)
        df = df.withColumn("vehicle_value_band", value_band)
    return keep_first(df.filter(F.col("vehicle_id").isNotNull()), "vehicle_id", order_by)
