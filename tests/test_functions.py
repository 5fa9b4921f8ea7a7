from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veritable.functions import dates, numbers, text
from veritable.sources.raw import normalize_nulls

WORDS = [
    "in-transit", "In-Transit", "3d print", "3D Print", "o'brien", "\ttab padded\t", " space ",
    "", " ", "café crème", "CAFÉ", "McDonald", "a1b2", "x\ty", " nbsp ", "ÉLAN", None,
]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def python_initcap(value):
    """Words are runs of letters and digits."""
    out, inside = "", False
    for ch in value:
        out += ch.lower() if inside else ch.upper()
        inside = ch.isalnum()
    return out


def test_title_and_strip_agree_with_python(spark):
    x = F.col("x")
    rows = column(spark, WORDS).select(
        "x", text.strip(x), text.title(text.strip(x)), text.differs_from_title(x)).collect()
    for value, stripped, titled, differs in rows:
        if value is None:
            assert (stripped, titled, differs) == (None, None, None)
        else:
            canonical = value.strip().title()
            assert (stripped, titled) == (value.strip(), canonical)
            assert differs == (value != canonical)


def test_casing_keeps_every_character(spark):
    x = F.col("x")
    value = "a\uffff b-3d\uffff"
    row = column(spark, [value]).select(text.title(x), text.initcap(x)).first()
    assert tuple(row) == (value.title(), python_initcap(value))


def test_initcap_counts_digits_as_word_parts(spark):
    x = F.col("x")
    rows = column(spark, WORDS).select(
        "x", text.initcap(F.trim(x)), text.differs_from_initcap(x)).collect()
    for value, capitalized, differs in rows:
        if value is not None:
            canonical = python_initcap(value.strip(" "))
            assert capitalized == canonical
            assert differs == (value != canonical)


@hypothesis_settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abzABZ019éÉñ -'\t_.", max_size=12), min_size=20, max_size=60))
def test_casing_agrees_with_python_on_any_text(spark, values):
    x = F.col("x")
    rows = column(spark, values).select(
        "x", text.title(text.strip(x)), text.differs_from_title(x),
        text.initcap(F.trim(x)), text.differs_from_initcap(x)).collect()
    for value, titled, not_titled, capitalized, not_capitalized in rows:
        expected = value.strip().title()
        assert (titled, not_titled) == (expected, value != expected)
        expected = python_initcap(value.strip(" "))
        assert (capitalized, not_capitalized) == (expected, value != expected)


def test_prefix(spark):
    x = F.col("x")
    rows = column(spark, ["12345", "SKU1", "sku1", "PROD00A7", None]).select(
        text.leading_letters(x), text.replace_prefix(x, "SKU")).collect()
    assert [tuple(r) for r in rows] == [
        (None, "SKU12345"), ("SKU", "SKU1"), ("sku", "SKU1"), ("PROD", "SKU00A7"), (None, None)]


def test_null_tokens(spark):
    values = [*text.NULL_TOKENS, " ", "N/A ", "none", "x"]
    kept = normalize_nulls(column(spark, values)).filter("x is not null").collect()
    assert [r.x for r in kept] == [" ", "N/A ", "none", "x"]


DATES = [
    "9-5-2025", "09-05-2025", "08/10/2025", "31-02-2020", "29-02-2024", "29-02-2023",
    "05-09-2025 10:00", "05-09-2025\n", "2025-9-5", "2025-09-05", "20250905", "009-05-2025",
    "00-01-2020", "01-13-2020", "01-01-25", "01-01-0000", "unknown", "", None,
    "2025-01-01T10:00:00", "2025-1-1T1:0:0", "2025-01-01 10:00:00", "2025-01-01T24:00:00",
    "2025-01-01T10:00:00Z", "2025-01-01T10:00",
]


@pytest.mark.parametrize("fmt", [dates.DMY, dates.MDY, dates.YMD, dates.ISO_SECONDS])
def test_parse_failures_agree_with_pandas(spark, fmt):
    rows = column(spark, DATES).select("x", dates.parse_fails(F.col("x"), fmt)).collect()
    parsed = pd.to_datetime(pd.Series(DATES), format=fmt, errors="coerce")
    for (value, fails), expected in zip(rows, parsed):
        assert fails == (value is not None and pd.isna(expected)), value


def test_formats_are_tried_in_order(spark):
    x = F.col("x")
    rows = {
        r[0]: (r[1], r[2]) for r in column(spark, DATES).select(
            "x", dates.flexible_date(x), dates.matched_format(x, dates.FLEXIBLE_FORMATS)).collect()
    }
    assert rows["9-5-2025"] == (dt.date(2025, 5, 9), 0)
    assert rows["08/10/2025"] == (dt.date(2025, 8, 10), 1)
    assert rows["2025-09-05"] == (dt.date(2025, 9, 5), 2)
    for bad in ("31-02-2020", "05-09-2025 10:00", "01-01-0000", "unknown", None):
        assert rows[bad] == (None, None)


def test_sql_function_is_the_same(spark):
    dates.register_sql_functions(spark)
    df = column(spark, DATES)
    assert df.selectExpr("parse_flexible_date(x)").collect() == df.select(
        dates.flexible_date(F.col("x"))).collect()


def test_unknown_directive_is_refused(spark):
    with pytest.raises(ValueError, match="%B"):
        dates.has_shape(F.col("x"), "%d %B %Y")


def test_numbers(spark):
    values = ["1", "-1.00", ".5", "5.", "+3", " 7 ", "1e3", "12d", "1f", "0x1", "1,000", "abc", None]
    rows = column(spark, values).select(numbers.to_number(F.col("x"))).collect()
    expected = pd.to_numeric(pd.Series(values), errors="coerce")
    assert [r[0] for r in rows] == [None if pd.isna(v) else v for v in expected]


def test_rounding(spark):
    x = F.col("x")
    rows = column(spark, [0.00005, 0.00015, 0.12345, 3.275 / 100], "double").select(
        numbers.round_half_even(x, 4)).collect()
    assert [r[0] for r in rows] == list(pd.Series([0.00005, 0.00015, 0.12345, 0.03275]).round(4))
    halves = spark.sql("SELECT 1L AS part, 20000L AS whole UNION ALL SELECT 1L, 0L")
    share = numbers.round_half_up(numbers.share(F.col("part"), F.col("whole")), 4)
    assert [None if r[0] is None else float(r[0]) for r in halves.select(share).collect()] == [
        0.0001, None]
