"""Calendar parts of a transaction date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_BASES = ("calendar", "iso")


def year_number(date: str | Column, basis: str = "calendar") -> Column:
    """Year to pair with an ISO week number.

    ``calendar`` puts 2023-01-01 in (2023, 52); ``iso`` puts it in (2022, 52), the week it belongs to.
    """
    if basis not in YEAR_BASES:
        raise ValueError(f"year basis must be one of {YEAR_BASES}, got {basis!r}")
    date = F.col(date) if isinstance(date, str) else date
    if basis == "calendar":
        return F.year(date)
    return F.extract(F.lit("YEAROFWEEK"), date)


def week_number(date: str | Column) -> Column:
    """ISO week, 1 to 53."""
    return F.weekofyear(date)


def month_number(date: str | Column) -> Column:
    return F.month(date)
