"""Null rules, numeric casts and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(condition: Column) -> Column:
    """A null comparison counts as not met."""
    return F.coalesce(condition, F.lit(False))


def differs(a: Column, b: Column) -> Column:
    """Inequality in which null differs from every value but null."""
    return ~a.eqNullSafe(b)


def in_list(value: Column, members) -> Column:
    return is_true(value.isin(list(members)))


def blank_to_null(value: Column) -> Column:
    text = F.trim(value.cast("string"))
    return F.when(text != "", text)


def to_double(value: Column) -> Column:
    """Text to number; blanks and unreadable text become null."""
    return blank_to_null(value).try_cast("double")


def or_zero(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def floor_at(value: Column, lowest: float = 0.0) -> Column:
    """Raise values under ``lowest``; null stays null."""
    return F.when(value < lowest, F.lit(lowest)).otherwise(value)


# Types whose text says the same double; a float's text says another one.
_DOUBLES = ("double", "tinyint", "smallint", "int", "bigint")
# Doubles below are exact if they are whole, and stay as they are when rounded.
_EXACT_BELOW = 1e15


def comparable_number(
    value: Column, digits: int = 2, null_is_zero: bool = True, kind: str | None = None
) -> Column:
    """Rounded half-even, so 560 and 560.0 compare equal, and so do null and 0
    unless told apart.

    ``kind`` is the type of the value, where known: doubles are then not read by way of
    their text. Whole numbers are not rounded, but lose the sign of a zero.
    """
    number = value.cast("double") if kind in _DOUBLES else to_double(value)
    whole = (F.abs(number) < _EXACT_BELOW) & (F.rint(number) == number)
    rounded = F.when(whole, number + F.lit(0.0)).otherwise(F.bround(number, digits))
    return F.coalesce(rounded, F.lit(0.0)) if null_is_zero else rounded
