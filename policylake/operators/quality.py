"""Checks that run before a table is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import finite
from .lookup import lookup

# Storage lengths of text columns, and the type names for the other kinds.
TEXT_LENGTHS = (50, 100, 255)


def null_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities to null in every floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: finite(F.col(f"`{c}`")) for c in floats})


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that are null or repeated, with their row counts."""
    return (
        df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
        .filter((F.col("rows") > 1) | F.col("key").isNull())
    )


def rejected_rows(df: DataFrame, key: str) -> DataFrame:
    """Every row that a keyed table would refuse, with the reason."""
    repeated = key_violations(df, key).filter("key is not null").select(
        F.col("key").alias(key), F.lit(True).alias("__repeated")
    )
    marked = lookup(df, repeated, key, ["__repeated"], unique=True)
    reason = F.when(F.col(key).isNull(), "null key").when(F.col("__repeated"), "repeated key")
    return marked.withColumn("reason", reason).filter("reason is not null").drop("__repeated")


def storage_type(dtype: T.DataType, length: Column) -> Column:
    """Name of the storage type of a column, by its type and longest text."""
    if isinstance(dtype, T.IntegralType):
        return F.lit("BIGINT")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.lit("FLOAT")
    if isinstance(dtype, T.BooleanType):
        return F.lit("BIT")
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.lit("DATETIME2")
    name = F.when(length.isNull(), f"NVARCHAR({TEXT_LENGTHS[0]})")
    for limit in TEXT_LENGTHS:
        name = name.when(length <= limit, f"NVARCHAR({limit})")
    return name.otherwise("NVARCHAR(MAX)")


def storage_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, storage type, longest text and number of filled values."""
    def longest(f: T.StructField) -> Column:
        return F.max(F.length(f.name)) if isinstance(f.dataType, T.StringType) else F.lit(None).cast("int")

    fields = df.schema.fields
    one = df.agg(*[F.struct(longest(f).alias("l"), F.count(f.name).alias("n")).alias(f.name) for f in fields])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            storage_type(f.dataType, F.col(f.name)["l"]).alias("storage_type"),
            F.col(f.name)["l"].alias("max_length"),
            F.col(f.name)["n"].alias("filled"),
        )
        for f in fields
    ]
    return one.select(F.inline(F.array(*rows)))
