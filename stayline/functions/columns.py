"""Column helpers with explicit null rules.

Ratios never raise under ANSI mode, clipping keeps nulls, flags turn an
unknown comparison into 0 and row sums treat a null as 0.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound ``c``; a null stays null (``greatest``/``least`` alone would not)."""
    c = as_col(c)
    bounded = c
    if lo is not None:
        bounded = F.greatest(bounded, F.lit(lo))
    if hi is not None:
        bounded = F.least(bounded, F.lit(hi))
    return F.when(c.isNotNull(), bounded)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives null for a zero denominator."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def flag(predicate: Column) -> Column:
    """Predicate as 0/1, an unknown outcome counts as 0."""
    return F.coalesce(predicate, F.lit(False)).cast("int")


def row_sum(cols: Iterable[Column | str]) -> Column:
    """Sum across columns with null as 0; 0.0 when the list is empty."""
    terms = [F.coalesce(as_col(c).cast("double"), F.lit(0.0)) for c in cols]
    return reduce(add, terms, F.lit(0.0)) if terms else F.lit(0.0)


def row_max(cols: Iterable[Column | str]) -> Column:
    """Largest non-null value across columns."""
    cols = [as_col(c) for c in cols]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def differs(c: Column | str, value) -> Column:
    """``c != value`` that keeps null rows."""
    return ~as_col(c).eqNullSafe(F.lit(value))


def nulls_in_row(cols: Iterable[str]) -> Column:
    """Number of null columns in the row."""
    return reduce(add, [F.col(c).isNull().cast("int") for c in cols], F.lit(0))


def nan_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def days_between(end: Column | str, start: Column | str) -> Column:
    """Whole days from ``start`` to ``end``."""
    return F.datediff(as_col(end), as_col(start))


def years_before(reference: str, c: Column | str) -> Column:
    """Years between a date column and a fixed reference date."""
    return days_between(F.lit(reference).cast("date"), c) / F.lit(365.25)


def quarter_key(c: Column | str) -> Column:
    c = as_col(c)
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


def month_key(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")
