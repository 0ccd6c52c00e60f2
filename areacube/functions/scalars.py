"""Column helpers with the reference's NULL behaviour (STR*, DAT*, MTH3, CND*).

All are built-in Spark expressions (whole-stage codegen, no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_digits(c: Column) -> Column:
    """STR4: first run of digits, NULL when there is none."""
    return F.regexp_substr(c, F.lit(r"\d+"))


def as_number(c: Column, kind: str = "double") -> Column:
    """MTH3: text -> number, unreadable text -> NULL (R's ``as.numeric``)."""
    return F.trim(c).try_cast(kind)


def from_position(c: Column, start: int) -> Column:
    """STR1: ``str_sub(x, start = k)``."""
    return F.substr(c, F.lit(start))


def capture(c: Column, pattern: str, group: int = 1) -> Column:
    """STR5: ``str_match(x, p)[, g]``: NULL when the pattern does not match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def zero_pad(c: Column, width: int) -> Column:
    """STR13: ``sprintf("%0wd", x)`` on a number; NULL stays NULL (D8), never truncates (T5)."""
    return F.when(c.isNotNull(), F.format_string(f"%0{width}d", c.cast("long")))


def school_end_year(c: Column) -> Column:
    """DAT1: ``"2020-2021"`` -> 2021 (first four characters + 1), NULL if unreadable."""
    return F.substring(c, 1, 4).try_cast("int") + F.lit(1)


def period_year(c: Column) -> Column:
    """DAT2: period code ``"2020JJ00"`` -> 2020."""
    return first_digits(c).try_cast("int")


# Frequency part of an open-statistics period code -> frequency letter.
PERIOD_FREQ = {"JJ": "Y", "KW": "Q", "MM": "M"}


def period_frequency(c: Column) -> Column:
    """DAT3: frequency letter of a period code (``JJ`` year, ``KW`` quarter, ``MM`` month)."""
    part = F.substring(c, 5, 2)
    out = F.lit(None).cast("string")
    for k, v in PERIOD_FREQ.items():
        out = F.when(part == k, F.lit(v)).otherwise(out)
    return out


def period_date(c: Column) -> Column:
    """DAT3: first day of the period (year, quarter or month)."""
    year = F.substring(c, 1, 4).try_cast("int")
    num = F.substring(c, 7, 2).try_cast("int")
    part = F.substring(c, 5, 2)
    month = (F.when(part == "JJ", F.lit(1))
             .when(part == "KW", (num - 1) * 3 + 1)
             .when(part == "MM", num))
    return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))


def r_ifelse(cond: Column, yes: Column, no: Column) -> Column:
    """CND1: ``ifelse``: a NULL condition gives NULL."""
    return F.when(cond, yes).when(~cond, no)


def nan_to_null(c: Column) -> Column:
    """PRJ10, UDF2, CND4: NaN becomes NULL natively (the reference used a lambda
    per column); the build itself never produces NaN, see T1-T3."""
    return F.nanvl(c, F.lit(None).cast("double"))
