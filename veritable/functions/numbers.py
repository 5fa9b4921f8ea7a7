"""Numeric expressions: safe parsing and the rounding rules of the two score variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"


def to_number(c: Column) -> Column:
    """DOUBLE, or NULL for text that is not a number. Spark alone would accept ``12d``."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def share(part: Column, whole: Column) -> Column:
    """Exact decimal ``part / whole``; NULL when the whole is zero."""
    return part.cast("decimal(20,0)") / F.nullif(whole.cast("decimal(20,0)"), F.lit(0))


def round_half_up(c: Column, digits: int) -> Column:
    return F.round(c, digits)


def round_half_even(c: Column, digits: int) -> Column:
    """Rounding of a DOUBLE by scaling, as numpy does it."""
    scale = float(10**digits)
    return F.rint(c * scale) / scale
