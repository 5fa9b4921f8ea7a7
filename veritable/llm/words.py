"""Word arrays as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything that is not an ASCII digit, a lower-case ASCII letter or beyond ASCII.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """Lower-cased words of a text; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS, -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
