"""Strict date parsing with one or several formats, written as strftime patterns.

A value is parsed only by a format whose shape it has, so a miss costs one regex search
and not a parser exception, and text after the date is never ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

DMY = "%d-%m-%Y"
MDY = "%m/%d/%Y"
YMD = "%Y-%m-%d"
ISO_SECONDS = "%Y-%m-%dT%H:%M:%S"

FLEXIBLE_FORMATS = (DMY, MDY, YMD)

# strftime directive -> (Spark pattern letters, regex for its digits)
_DIRECTIVES = {
    "%d": ("d", "[0-9]{1,2}"),
    "%m": ("M", "[0-9]{1,2}"),
    "%Y": ("yyyy", "(?!0000)[0-9]{4}"),
    "%H": ("H", "[0-9]{1,2}"),
    "%M": ("m", "[0-9]{1,2}"),
    "%S": ("s", "[0-9]{1,2}"),
}


def _translate(fmt: str) -> tuple[str, str]:
    """strftime format → (Spark datetime pattern, anchored regex of its shape)."""
    pattern, shape = "", ""
    for part in re.findall(r"%.|[^%]+", fmt):
        if part in _DIRECTIVES:
            letters, digits = _DIRECTIVES[part]
            pattern, shape = pattern + letters, shape + digits
        elif part.startswith("%"):
            raise ValueError(f"unsupported directive {part} in date format {fmt!r}")
        else:
            pattern += "'" + part.replace("'", "''") + "'"
            shape += re.sub(r"([^A-Za-z0-9 ])", r"\\\1", part)
    return pattern, rf"^{shape}\z"


def has_shape(c: Column, fmt: str) -> Column:
    return c.rlike(_translate(fmt)[1])


def parse_date(c: Column, fmt: str) -> Column:
    """DATE, or NULL when the text has another shape or names no calendar day."""
    return F.when(has_shape(c, fmt), F.try_to_date(c, _translate(fmt)[0]))


def parse_first(c: Column, formats: Sequence[str]) -> Column:
    """DATE by the first format that fits."""
    return F.coalesce(*[parse_date(c, fmt) for fmt in formats])


def matched_format(c: Column, formats: Sequence[str]) -> Column:
    """Position of the first format that fits; NULL when none does."""
    return F.coalesce(
        *[F.when(parse_date(c, fmt).isNotNull(), F.lit(i)) for i, fmt in enumerate(formats)]
    )


def parse_fails(c: Column, fmt: str) -> Column:
    """A value is present but is not a date or timestamp of this format."""
    pattern, shape = _translate(fmt)
    parsed = F.try_to_timestamp(c, F.lit(pattern)) if "%H" in fmt else F.try_to_date(c, pattern)
    return c.isNotNull() & (~c.rlike(shape) | parsed.isNull())


def flexible_date(c: Column) -> Column:
    return parse_first(c, FLEXIBLE_FORMATS)


def register_sql_functions(spark: SparkSession, database: str | None = None) -> None:
    """Publish ``parse_flexible_date(text)`` for SQL users, as an inlined SQL function.

    It belongs to the session, or to ``database`` if one is given.
    """
    branches = ", ".join(
        "CASE WHEN rlike(raw_val, r'{1}') THEN try_to_date(raw_val, r\"{0}\") END".format(
            *_translate(fmt)
        )
        for fmt in FLEXIBLE_FORMATS
    )
    target = (f"FUNCTION {database}.parse_flexible_date" if database
              else "TEMPORARY FUNCTION parse_flexible_date")
    spark.sql(f"CREATE OR REPLACE {target}(raw_val STRING) "
              f"RETURNS DATE RETURN coalesce({branches})")
