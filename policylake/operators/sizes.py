"""Size estimates from table metadata, and tables of a few literal rows; no job is started."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_bytes(df: DataFrame) -> int | None:
    """Bytes of all sources ``df`` reads, or None where the optimizer cannot tell.

    The sum over the leaves is used because the optimizer's figure for a join is the
    product of its inputs, far above what a keyed lookup returns.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except Exception:
        return None


def is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a table of files as it is read, without any further step."""
    return df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """A handful of rows as literals of the plan, without a Python worker to feed them."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
