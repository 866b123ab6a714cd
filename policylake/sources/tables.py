"""Zones of versioned Parquet tables, one folder per table, written whole or appended to."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import key_violations, null_nonfinite
from ..operators.schema import same_headers
from . import snapshots

# The ten output tables, their zone and their key.
OUTPUT_TABLES = (
    ("stg", "clean_clients", "client_id"),
    ("stg", "clean_policies", "contract_id"),
    ("stg", "clean_vehicles", "vehicle_id"),
    ("stg", "clean_claims", "claim_id"),
    ("dw", "dim_client", "client_id"),
    ("dw", "dim_policy", "contract_id"),
    ("dw", "dim_vehicle", "vehicle_id"),
    ("dw", "dim_time", "date_key"),
    ("dw", "fact_claim", "claim_id"),
    ("ml", "ml_claim", "claim_id"),
)


def read_table(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """``zone.table`` below ``root``, by default its latest version; the optimizer decides which columns are read.

    The rows are those of the version found now, also if the table is replaced before they are read. A folder without versions is read as it is.
    """
    path = table_path(root, name)
    found = snapshots.read_version(spark, path, version)
    return spark.read.parquet(path) if found is None else snapshots.rows(spark, path, found)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def existing_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    try:
        return read_table(spark, root, name)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def write_table(
    df: DataFrame, root: str, name: str, mode: str = "append", key: str | None = None, replace_changed: bool = False, add_columns: bool = False,
) -> None:
    """Write one table, ``append`` or ``replace``, as its next version.

    Non-finite numbers become null. A key must be filled and unique. The first write of a
    table must have rows. Rows with other column names than the present table has are not appended, but with
    ``replace_changed`` they replace it, and with ``add_columns`` their new columns join the table, null in its old rows, and those they lack
    are null in them. Readers see the old version or the new one, and a write that fails leaves the old one.
    A keyed append looks its keys up only in the files whose key ranges they touch. Of two writers at once, the second checks its keys against what the
    first has added and then adds its own.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"mode is {mode!r}, not append or replace")
    spark, path = df.sparkSession, table_path(root, name)
    df = null_nonfinite(df)
    present = existing_table(spark, root, name)
    if (present is None or not (add_columns or same_headers(present, df))) and df.isEmpty():
        raise ValueError(f"{name} cannot be created from an empty table")
    add = mode == "append" and present is not None
    if add and not add_columns and not same_headers(present, df):
        if not replace_changed:
            raise ValueError(f"{name}: the column names differ from the present table's")
        add = False
    if key:
        _refuse(name, key, [r["key"] for r in key_violations(df.select(key), key).limit(5).collect()])
    before = snapshots.read_version(spark, path)
    if before is None and add:
        before = snapshots.Version(0, snapshots.numbered(present.schema), ("",))
    schema = snapshots.numbered(_joined(before.schema, df.schema) if add else df.schema, before.schema if before else None)
    names = {c.lower(): c for c in df.columns}
    df = df.select(*[(F.col(f"`{names[f.name.lower()]}`") if f.name.lower() in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    key = next((f.name for f in schema.fields if key and f.name.lower() == key.lower()), None)
    checked: tuple[str, ...] = ()
    if add and key:
        _refuse(name, key, _present_keys(spark, path, before, df.select(key)))
        checked = before.folders
    fresh = snapshots.write_folder(df, path, key)
    while True:
        folders, known = (before.folders, before.indexed) if add else ((), ())
        indexed = (*known, fresh) if key else known
        number = before.number + 1 if before else 1
        written = tuple((f, before.schema_of(f)) for f in folders if before.schema_of(f) != schema)
        if snapshots.commit(spark, path, snapshots.Version(number, schema, (*folders, fresh), key, indexed, written)):
            return
        before, wanted = snapshots.read_version(spark, path), schema
        if add and snapshots.numbered(_joined(before.schema, wanted), before.schema) != wanted:
            raise ValueError(f"{name} was given other columns meanwhile")
        if add and key:
            new = tuple(f for f in before.folders if f not in checked)
            part = replace(before, folders=new, indexed=tuple(f for f in before.indexed if f in new))
            _refuse(name, key, _present_keys(spark, path, part, df.select(key)))
            checked = before.folders


def _joined(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns, then those that are new by name, ignoring case."""
    known = {n.lower() for n in old.names}
    return T.StructType([*old.fields, *[f for f in new.fields if f.name.lower() not in known]])


def _present_keys(spark: SparkSession, path: str, version: snapshots.Version, batch: DataFrame) -> list:
    """Some keys of the batch that the version holds."""
    key = batch.columns[0]
    files = snapshots.files_that_may_hold(spark, path, version, batch)
    if not files:
        return []
    held = snapshots.rows(spark, path, version, files).select(F.col(key).alias("key"))
    return [r["key"] for r in batch.select(F.col(key).alias("key")).join(held, "key", "left_semi").limit(5).collect()]


def _refuse(name: str, key: str, bad: list) -> None:
    if bad:
        raise ValueError(f"{name}: {key} is null or repeated, e.g. {bad}")


def write_outputs(tables: dict[str, DataFrame], root: str, mode: str = "replace") -> None:
    """Write every output that is present to its zone, with its key."""
    for zone, name, key in OUTPUT_TABLES:
        if tables.get(name) is not None:
            write_table(tables[name], root, f"{zone}.{name}", mode, key)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Table name and row count, one row per table."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
