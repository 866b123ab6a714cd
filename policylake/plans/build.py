"""All ten output tables from the four raw ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame

from ..operators.quality import null_nonfinite
from ..session import concurrently, file_slices, stage_built, stage_parts
from .bounds import Bounds, learned
from .claims import claim_bounds, clean_claims, parse_claims
from .clients import clean_clients, client_bounds, parse_clients
from .policies import clean_policies, parse_policies, policy_bounds
from .vehicles import clean_vehicles, parse_vehicles, vehicle_bounds
from .warehouse import claim_wide, dim_client, dim_policy, dim_time, dim_vehicle, fact_claim, ml_claim, wide_bounds

RAW_NAMES = ("clients", "policies", "vehicles", "claims")


def learn_bounds(raw: Mapping[str, DataFrame], as_of: date | None = None) -> dict[str, Bounds]:
    """Limits of the four clean tables, each from a few passes over its typed rows."""
    spark = raw["clients"].sparkSession
    return concurrently(spark, {
        "clients": lambda: learned(parse_clients(raw["clients"]), client_bounds, None, "clients")[1],
        "policies": lambda: learned(parse_policies(raw["policies"]), policy_bounds, None, "policies")[1],
        "vehicles": lambda: learned(parse_vehicles(raw["vehicles"], as_of), vehicle_bounds, None, "vehicles")[1],
        "claims": lambda: learned(parse_claims(raw["claims"]), claim_bounds, None, "claims")[1],
    })


def clean_tables(
    raw: Mapping[str, DataFrame],
    bounds: Mapping[str, Bounds] | None = None,
    as_of: date | None = None,
    order_by: Mapping[str, Sequence[str]] | None = None,
    staged: bool = False,
) -> dict[str, DataFrame]:
    """The four clean tables, built side by side; without given ``bounds`` each learns its own. ``staged`` also writes them for several readers."""
    spark = raw["clients"].sparkSession
    raw = {n: null_nonfinite(df) for n, df in raw.items()}
    limits = dict.fromkeys(RAW_NAMES) if bounds is None else bounds
    order = {n: tuple((order_by or {}).get(n, ())) for n in RAW_NAMES}
    built = {
        "clean_clients": lambda: clean_clients(raw["clients"], limits["clients"], order["clients"]),
        "clean_policies": lambda: clean_policies(raw["policies"], limits["policies"], order["policies"]),
        "clean_vehicles": lambda: clean_vehicles(raw["vehicles"], limits["vehicles"], as_of, order["vehicles"]),
        "clean_claims": lambda: clean_claims(raw["claims"], limits["claims"], order["claims"]),
    }
    return concurrently(spark, {n: (lambda f=f, n=n: stage_built(spark, f, n)) if staged else f for n, f in built.items()})


def wide_claims(clean: Mapping[str, DataFrame]) -> DataFrame:
    return claim_wide(clean["clean_claims"], clean["clean_policies"], clean["clean_clients"], clean["clean_vehicles"])


def stage_wide(clean: Mapping[str, DataFrame]) -> DataFrame:
    """The wide claims, staged. The lookups deal out ever wider rows, so many claims go through them in slices: only one slice is in shuffle files at a time."""
    return stage_parts((wide_claims({**clean, "clean_claims": part}) for part in file_slices(clean["clean_claims"])), "claim_wide")


def build_outputs(
    raw: Mapping[str, DataFrame],
    as_of: date | None = None,
    order_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """The ten outputs.

    The clean tables and the wide claims are each read several times, so they are staged as
    Parquet: the de-duplication and the three lookups then run once for all outputs.
    """
    clean = clean_tables(raw, as_of=as_of, order_by=order_by, staged=True)
    return clean_outputs(clean) | wide_outputs(stage_wide(clean))


def clean_outputs(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The eight outputs made from the clean tables alone."""
    return {
        **clean,
        "dim_client": dim_client(clean["clean_clients"], unique=True),
        "dim_policy": dim_policy(clean["clean_policies"], unique=True),
        "dim_vehicle": dim_vehicle(clean["clean_vehicles"], unique=True),
        "dim_time": dim_time(clean["clean_policies"], clean["clean_claims"]),
    }


def wide_outputs(wide: DataFrame) -> dict[str, DataFrame]:
    """The two outputs made from the wide claims."""
    limits = wide_bounds(wide)
    return {"fact_claim": fact_claim(wide, limits), "ml_claim": ml_claim(wide, limits)}
