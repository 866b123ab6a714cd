"""Rules as short chains of column steps, applied to many columns at once.

A rule that looks at a value several times would repeat the expression behind it each
time, and nested rules would multiply it. Each step therefore gets its own projection:
the optimizer keeps them apart, and the value is computed once per row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[Column], Column]
Steps = Sequence[Step]


def apply_steps(df: DataFrame, rules: Mapping[str, Steps]) -> DataFrame:
    """Apply the rules to the named columns that exist, all columns one step at a time."""
    present = {c: steps for c, steps in rules.items() if c in df.columns}
    for depth in range(max((len(s) for s in present.values()), default=0)):
        df = df.withColumns({c: s[depth](F.col(c)) for c, s in present.items() if depth < len(s)})
    return df
