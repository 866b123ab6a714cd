"""Header, alias and projection rules. They look at column names only, never at rows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accented letters and their plain ones.
ACCENTED = "éèêëàâîïôùûüçÉÈÊËÀÂÎÏÔÙÛÜÇ"
PLAIN = "eeeeaaiiouuucEEEEAAIIOUUUC"

# Accepted names of each key column, first match wins.
KEY_ALIASES = {
    "client_id": ("client_id", "clientid", "id_client", "client"),
    "contract_id": ("contract_id", "contractid", "id_contract", "contrat_id"),
    "vehicle_id": ("vehicle_id", "vehicleid", "id_vehicle", "vehicule_id"),
    "claim_id": ("claim_id", "claimid", "id_claim", "sinistre_id"),
}


def header_name(name: str) -> str:
    """Snake-case form of a column header."""
    plain = name.strip().translate(str.maketrans(ACCENTED, PLAIN)).replace("/", "_")
    kept = re.sub(r"[^\w\s-]", "", plain).replace(" ", "_")
    return re.sub(r"_{2,}", "_", re.sub(r"-+", "_", kept)).lower()


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[header_name(c) for c in df.columns])


def require_column(df: DataFrame, name: str, candidates: Sequence[str] | None = None) -> DataFrame:
    """Rename the first accepted spelling to ``name``; raise where none is present."""
    tried = tuple(candidates or KEY_ALIASES[name])
    for candidate in tried:
        if candidate in df.columns:
            return df if candidate == name else df.withColumnRenamed(candidate, name)
    raise KeyError(f"required column {name!r} is absent; tried {list(tried)}, found {df.columns[:30]}")


def with_optional(df: DataFrame, defaults: dict[str, tuple[str, object]]) -> DataFrame:
    """Add each absent column with its type and default value."""
    absent = {n: F.lit(v).cast(t) for n, (t, v) in defaults.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def keep_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[n for n in names if n in df.columns])


def column_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def compare_headers(left: DataFrame, right: DataFrame) -> dict[str, str]:
    """Column name (lower case) to ``both``, ``missing`` (only left) or ``extra`` (only right)."""
    a, b = ({c.lower() for c in d.columns} for d in (left, right))
    return {n: "both" if n in a and n in b else "missing" if n in a else "extra" for n in sorted(a | b)}


def same_headers(left: DataFrame, right: DataFrame) -> bool:
    return set(compare_headers(left, right).values()) <= {"both"}


def feature_kind(dtype: T.DataType) -> str | None:
    """``numeric``, ``text`` or None for types that are no model features."""
    if isinstance(dtype, T.NumericType):
        return "numeric"
    return "text" if isinstance(dtype, T.StringType) else None


def feature_columns(df: DataFrame) -> dict[str, str | None]:
    return {f.name: feature_kind(f.dataType) for f in df.schema.fields}


def filled_counts(df: DataFrame) -> dict[str, Column]:
    """Aggregates counting the non-null values of each column."""
    return {c: F.count(F.col(f"`{c}`")) for c in df.columns}
