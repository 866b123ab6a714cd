"""One row per key, chosen the same way on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str, order_by: Sequence[str] = (), hashed: bool = False) -> DataFrame:
    """First row of each key by ``order_by``, then by all other columns (nulls first).

    Rows carry no input order on a cluster, so the order is spelled out and made total.
    The rank filter lets Spark keep one row per key on the map side before the shuffle,
    so a key with a third of all rows still sends one row per task. ``hashed`` sorts by a hash of the key first, which tells
    keys that begin alike apart sooner; the rows are then not dealt by the key itself, so a later join by it deals them again.
    """
    order = [c for c in order_by if c != key]
    order += [c for c in df.columns if c != key and c not in order]
    plain = {f.name: "map<" not in f.dataType.simpleString() for f in df.schema.fields}
    by = [F.col(c) if plain[c] else F.to_json(F.struct(c)) for c in order]  # maps have no order of their own
    keys = [F.xxhash64(key), F.col(key)] if hashed else [F.col(key)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[c.asc_nulls_first() for c in by]))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")
