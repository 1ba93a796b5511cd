"""Features of the monthly risk history, a string with one digit per month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayline.functions.columns import as_col, flag

MONTHS = 24
MISSING_TEXT = "nan"  # how a missing history reads once it is turned into text


def risk_ever(c: Column | str) -> Column:
    return flag(F.trim(as_col(c)).rlike("[1-9]"))


def risk_recent(c: Column | str, months: int = 6) -> Column:
    return flag(F.right(F.trim(as_col(c)), F.lit(months)).rlike("[1-9]"))


def bad_months(c: Column | str) -> Column:
    return F.coalesce(F.length(F.regexp_replace(as_col(c), "[^1-9]", "")), F.lit(0))


def padded_history(c: Column | str) -> Column:
    """Text before any decimal point, zero-padded on the left to 24 months."""
    text = F.substring_index(F.trim(F.coalesce(as_col(c).cast("string"), F.lit(MISSING_TEXT))), ".", 1)
    return F.when(F.length(text) < MONTHS, F.lpad(text, MONTHS, "0")).otherwise(text)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _digit_mean(text: Column) -> Column:
    digits = F.filter(F.split(_digits(text), ""), lambda ch: ch != "")
    total = F.aggregate(digits, F.lit(0), lambda acc, ch: acc + ch.cast("int"))
    return F.try_divide(total.cast("double"), F.size(digits))


def risk_trend(c: Column | str) -> Column:
    """Mean of months 4-6 back minus mean of the last 3; above 0 is improving."""
    history = padded_history(c)
    recent = _digit_mean(F.right(history, F.lit(3)))
    prior = _digit_mean(F.left(F.right(history, F.lit(6)), F.lit(3)))
    return F.coalesce(prior - recent, F.lit(0.0))


def risk_volatility(c: Column | str, months: int = 12) -> Column:
    """Changes between neighbouring months: number of equal-digit runs minus one."""
    digits = _digits(F.right(padded_history(c), F.lit(months)))
    runs = F.length(F.regexp_replace(digits, r"(.)\1*", "$1"))
    return F.greatest(runs - 1, F.lit(0))


def months_at_current_risk(c: Column | str) -> Column:
    """Length of the trailing run of equal digits."""
    return F.length(F.regexp_extract(_digits(padded_history(c)), r"(.)\1*$", 0))
