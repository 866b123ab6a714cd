"""Date and time rules as Spark columns, all on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .steps import Steps
from .text import strip

COMPACT = r"^([0-9]{4})([0-9]{2})([0-9]{2})(?=$|[ T])"
# Two digits, two digits and a year, and no letters, so that only the order of the parts is left to change.
PLAIN_DAY_FIRST = r"^[0-9]{2}-[0-9]{2}-[0-9]{4}[^A-Za-z]*$"
DAY_FIRST = r"^([0-9]{1,2})[.-]([0-9]{1,2})[.-]([0-9]{4})"
# Years of two digits from 69 on belong to the last century.
DAY_FIRST_1900 = r"^([0-9]{1,2})[.-]([0-9]{1,2})[.-](69|[7-9][0-9])(?![0-9])"
DAY_FIRST_2000 = r"^([0-9]{1,2})[.-]([0-9]{1,2})[.-]([0-5][0-9]|6[0-8])(?![0-9])"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
DAY_AND_NAME = rf"^([0-9]{{1,2}})[ .-]+({'|'.join(MONTHS)})[a-z]*[ .,-]+([0-9]{{4}})"
NAME_AND_DAY = rf"^({'|'.join(MONTHS)})[a-z]*[ .-]+([0-9]{{1,2}})[ .,-]+([0-9]{{4}})"


def parsed_timestamp(dtype: str = "string") -> Steps:
    """ISO first, then day/month/year, each with an optional time; unreadable becomes null.

    Also read: yyyymmdd, years of two digits, and English month names before or after the day.
    """
    if dtype == "timestamp_ntz":
        return ()
    if dtype in ("timestamp", "date"):
        return (lambda c: c.cast("timestamp_ntz"),)
    return (
        lambda c: F.replace(strip(c.cast("string")), F.lit("/"), F.lit("-")),
        lambda c: F.when(_year_first(c), c).otherwise(_reordered(c)),
        lambda c: F.when(_year_first(c), c).try_cast("timestamp_ntz"),
    )


def _reordered(c: Column) -> Column:
    """The other spellings with the year first."""
    named = F.lower(c)
    for pattern, order in ((DAY_AND_NAME, "$3-$2-$1"), (NAME_AND_DAY, "$3-$1-$2")):
        named = F.regexp_replace(named, pattern, order)
    for number, name in enumerate(MONTHS, 1):
        named = F.replace(named, F.lit(f"-{name}-"), F.lit(f"-{number:02d}-"))
    digits = c
    for pattern, order in (
        (COMPACT, "$1-$2-$3"), (DAY_FIRST, "$3-$2-$1"), (DAY_FIRST_1900, "19$3-$2-$1"), (DAY_FIRST_2000, "20$3-$2-$1"),
    ):
        digits = F.regexp_replace(digits, pattern, order)
    plain = F.concat(F.substring(c, 7, 4), F.lit("-"), F.substring(c, 4, 3), F.substring(c, 1, 2), F.substr(c, F.lit(11)))
    return F.when(c.rlike(PLAIN_DAY_FIRST), plain).when(c.rlike("(?i)(" + "|".join(MONTHS) + ")"), named).otherwise(digits)


def _year_first(c: Column) -> Column:
    return F.substring(c, 5, 1) == "-"


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two zone-free timestamps, whatever the session time zone."""
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole elapsed days, the floor of 24-hour units; negative when ``end`` comes first."""
    return F.floor(elapsed_seconds(start, end) / F.lit(86400.0)).cast("double")


def elapsed_hours(start: Column, end: Column) -> Column:
    return elapsed_seconds(start, end) / F.lit(3600.0)


def date_key(c: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def claim_date_parts(c: Column) -> dict[str, Column]:
    return {
        "claim_year": F.year(c),
        "claim_month": F.month(c),
        "claim_quarter": F.quarter(c),
        "claim_dayofweek": F.weekday(c),
        "claim_hour": F.hour(c),
    }
