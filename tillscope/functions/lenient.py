"""Text conversions that give NULL instead of failing the job under ANSI mode.

A cheap pattern test comes before the cast where failures inside the cast are costly or where the cast
accepts more than it should.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def lenient_int(column: str | Column) -> Column:
    """Whole number in the range of an int; spaces around it are allowed."""
    text = _col(column)
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast("int"))


def lenient_double(column: str | Column) -> Column:
    """Finite decimal number; NaN, infinities, numbers beyond the range of a double and type suffixes are not read."""
    text = _col(column)
    value = text.try_cast("double")
    return F.when(text.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$") & is_finite(value), value)


def lenient_date(column: str | Column) -> Column:
    """Existing day written as yyyy-MM-dd, with all its digits."""
    text = _col(column)
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))


def is_finite(column: str | Column) -> Column:
    """Neither NaN nor infinite; NULL for NULL."""
    return F.abs(_col(column)) < float("inf")  # NaN sorts above infinity


def complete(df: DataFrame, columns: list[str]) -> Column:
    """Whether none of the columns is NULL, NaN or infinite."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, (FloatType, DoubleType))}
    checks = [F.coalesce(is_finite(c), F.lit(False)) if c in numeric else F.col(c).isNotNull() for c in columns]
    return reduce(and_, checks, F.lit(True))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
