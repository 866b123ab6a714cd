"""Number, flag and ratio rules as Spark columns. Missing is null, never NaN."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .steps import Step, Steps
from .text import strip

# Words that stand for yes and no.
TRUE_WORDS = ("1", "true", "vrai", "yes", "oui", "y", "t")
FALSE_WORDS = ("0", "false", "faux", "no", "non", "n", "f")

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
NOT_IN_NUMBERS = "[a-df-zA-DF-Z]"
# Fixed value: the first number of a text.
FIRST_NUMBER = r"[-+]?\d*\.?\d+"


def is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC_TYPES or dtype.startswith("decimal")


def finite(c: Column) -> Column:
    """Null for NaN and both infinities."""
    return F.when(F.abs(c) < float("inf"), c)


def within(low: float | None = None, high: float | None = None) -> Step:
    """Null outside the closed range; an open end still excludes infinity and NaN."""
    def run(c: Column) -> Column:
        above = c >= low if low is not None else c > float("-inf")
        below = c <= high if high is not None else c < float("inf")
        return F.when(above & below, c)

    return run


def _dotted(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(" "), F.lit("")), F.lit(","), F.lit("."))


def plain_number(c: Column) -> Column:
    """The double a text spells, else null. Casting alone would also take ``1d`` and ``Infinity``."""
    return F.when(~c.rlike(NOT_IN_NUMBERS), c).try_cast("double")


def strict_number(dtype: str = "string") -> Steps:
    """A whole text that is one number (decimal comma and blanks allowed), else null.

    Follow with ``within``, which also drops what is not finite.
    """
    if is_numeric(dtype) or dtype == "boolean":
        return (lambda c: c.cast("double"),)
    return (lambda c: _dotted(c.cast("string")), plain_number)


def _number_in(c: Column) -> Column:
    found = F.regexp_extract(_dotted(c), FIRST_NUMBER, 0).try_cast("double")
    return F.when(c.isin(*TRUE_WORDS), 1.0).when(c.isin(*FALSE_WORDS), 0.0).otherwise(found)


def flexible_number(dtype: str = "string") -> Steps:
    """Yes/no words as 1/0, else the first number found in the text, else null.

    No missing word holds a digit or means yes or no, so those come out as null too.
    """
    if is_numeric(dtype) or dtype == "boolean":
        return (lambda c: c.cast("double"),)
    return (lambda c: F.lower(strip(c.cast("string"))), _number_in)


def whole_count(dtype: str = "string", allow_negative: bool = False) -> Steps:
    """Floor of the number as a long; negatives become null unless allowed."""
    return (*flexible_number(dtype), within(None if allow_negative else 0), F.floor)


def _worded_flag(c: Column) -> Column:
    number = plain_number(c)
    return (
        F.when(c.isin(*TRUE_WORDS), True)
        .when(c.isin(*FALSE_WORDS), False)
        .otherwise(F.when(number.isin(0.0, 1.0), number == 1.0))
    )


def flag(dtype: str = "string") -> Steps:
    """Boolean from yes/no words or from any text worth 1 or 0, else null."""
    if dtype == "boolean":
        return ()
    if is_numeric(dtype):
        return (lambda c: F.when(c.isin(0, 1), c == 1),)
    return (lambda c: F.lower(strip(c.cast("string"))), _worded_flag)


def flag_number(dtype: str = "string") -> Steps:
    """The flag as 0/1."""
    return (*flag(dtype), lambda c: c.cast("bigint"))


def at_least_zero(c: Column) -> Column:
    return F.when(c < 0, 0.0).otherwise(c)


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, null where the divisor is zero."""
    return F.when(bottom != 0, top / bottom)


def clip(c: Column, low: float | None, high: float | None) -> Column:
    """Cap into [low, high]; a column without any value has no bounds and stays as it is."""
    if low is None or high is None:
        return c
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def weighted_score(parts: list[tuple[Column, float]]) -> Column:
    """Sum of value/weight with null as zero, never below zero; null without parts."""
    if not parts:
        return F.lit(None).cast("double")
    terms = [F.coalesce(c.cast("double"), F.lit(0.0)) / F.lit(float(w)) for c, w in parts]
    return F.greatest(F.lit(0.0), reduce(lambda a, b: a + b, terms))


def flag_count(flags: list[Column]) -> Column:
    """How many of the 0/1 flags are set; zero without flags."""
    return reduce(lambda a, b: a + b, [F.coalesce(f.cast("bigint"), F.lit(0)) for f in flags], F.lit(0).cast("bigint"))
