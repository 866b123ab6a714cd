"""Left lookup joins that keep the row count and survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import keep_first
from .sizes import source_bytes

TASK_BYTES = 128 << 20
LEAST_SALTS = 8
NULL_TASKS = 1 << 20
HOT_SHARE = 0.002
HOT_KEYS = 500


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """``(key, share)`` of the keys holding more than ``HOT_SHARE`` of the rows: at most ``1 / HOT_SHARE`` of them.

    One pass over the key column with a mergeable sketch of fixed size. The sketch only
    decides which keys get salted, so its error never touches the result.
    """
    found = df.filter(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.call_function("approx_top_k", F.col(key), F.lit(HOT_KEYS), F.lit(10 * HOT_KEYS)).alias("top")
    )
    return (
        found.select("rows", F.explode("top").alias("t"))
        .filter(F.col("t.count") > F.col("rows") * HOT_SHARE)
        .select(F.col("t.item").alias(key), (F.col("t.count") / F.col("rows")).alias("share"))
    )


def _dealt(df: DataFrame, parts: Column) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), parts).cast("int")


def splits_skew(df: DataFrame) -> bool:
    """Whether the session splits skewed join partitions by itself."""
    get = df.sparkSession.conf.get
    return get("spark.sql.adaptive.enabled") == "true" and get("spark.sql.adaptive.skewJoin.enabled") == "true"


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: Sequence[str],
    unique: bool = False,
    salted: bool | None = None,
) -> DataFrame:
    """``left`` with ``columns`` of the one matching row of ``right``; unmatched rows get nulls.

    ``right`` is reduced to its first row per key unless it is known to be ``unique``.
    A small right side is broadcast by Spark after its own size check. In a shuffle join Spark splits
    the partitions of hot and null keys. Where the session has that switched off, or with ``salted``, rows
    of a hot key are spread over as many tasks as their share of the bytes fills and the few hot rows of ``right``
    are repeated to meet them, and rows with a null key are spread freely; all other keys take the plain join.
    Names on both sides get the suffixes ``_x`` (left) and ``_y`` (right).
    """
    columns = [c for c in columns if c in right.columns and c != key]
    right = right if unique else keep_first(right.filter(F.col(key).isNotNull()), key)
    clash = [c for c in columns if c in left.columns]
    left = left.withColumnsRenamed({c: f"{c}_x" for c in clash})
    right = right.select(key, *[F.col(c).alias(f"{c}_y" if c in clash else c) for c in columns])
    if salted is None:
        salted = not splits_skew(left)
    if not salted:
        return left.join(right, key, "left")
    salts = F.greatest(F.lit(LEAST_SALTS), F.ceil(F.col("share") * F.lit((source_bytes(left) or 0) / TASK_BYTES))).cast("int")
    hot = hot_keys(left, key).select(key, salts.alias("__salts"))
    rows = left
    left = left.join(F.broadcast(hot), key, "left")
    salt = F.when(F.col(key).isNull(), _dealt(rows, F.lit(NULL_TASKS))).otherwise(F.coalesce(_dealt(rows, F.col("__salts")), F.lit(0)))
    left = left.withColumn("__salt", salt).drop("__salts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    right = right.join(F.broadcast(hot), key, "left").withColumn("__salt", F.explode(copies)).drop("__salts")
    return left.join(right, [key, "__salt"], "left").drop("__salt")
