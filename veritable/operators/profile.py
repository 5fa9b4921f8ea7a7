"""Profiling: columns, duplicate keys, references, key prefixes and date formats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritable.functions import dates, text
from veritable.functions.numbers import round_half_even
from veritable.operators import keyed
from veritable.operators.evaluate import Frames, union_all
from veritable.operators.rules import DATE_FORMATS

DateFormats = Mapping[str, Mapping[str, str]]


@dataclass(frozen=True)
class Reference:
    """``child.column`` should be found in ``parent.parent_column``."""

    child: str
    column: str
    parent: str
    parent_column: str
    skip_nulls: bool = False

    @property
    def label(self) -> str:
        return f"{self.child}.{self.column} not in {self.parent}"


DUPLICATE_CHECKS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("products", ("sku",)),
    ("products", ("product_name", "supplier_id")),
    ("suppliers", ("supplier_id",)),
)

REFERENCES = (
    Reference("products", "supplier_id", "suppliers", "supplier_id", skip_nulls=True),
    Reference("inventory", "sku", "products", "sku"),
    Reference("inventory_transactions", "sku", "products", "sku"),
    Reference("purchase_orders", "sku", "products", "sku"),
    Reference("purchase_orders", "supplier_id", "suppliers", "supplier_id"),
)


def _cells(frames: Frames) -> tuple[DataFrame, Column]:
    """All cells as (column number, value), and the labels of the numbers."""
    names = [(table, column) for table, df in frames.items() for column in df.columns]

    def cells_of(table: str, df: DataFrame) -> DataFrame:
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(names.index((table, c))).alias("number"),
                     F.col(c).cast("string").alias("value"))
            for c in df.columns
        ])))

    labels = F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(column).alias("column"))
        for table, column in names
    ])
    return union_all([cells_of(table, df) for table, df in frames.items()]), labels


def column_profile(frames: Frames, distinct_error: float | None = None) -> DataFrame:
    """Rows, NULLs, distinct values and untrimmed values of every column of every table.

    All cells become (column number, value) and are grouped once: repeated values collapse
    before the shuffle, and a table is read once however many columns it has. Columns of nearly
    unique values do not collapse; ``distinct_error`` is then the relative standard deviation
    (0.01 is 1%) that distinct counts may have: no cell is shuffled, only one sketch per task and
    column. The other counts stay exact.
    """
    cells, labels = _cells(frames)
    n, value = F.col("n"), F.col("value")
    if distinct_error is None:
        counted, distinct = keyed.group_sizes(cells, ["number", "value"]), F.count(value)
    else:
        counted = cells.withColumn("n", F.lit(1))
        distinct = F.approx_count_distinct(value, distinct_error)
    profile = counted.groupBy("number").agg(
        F.sum(n).alias("row_count"),
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("null_count"),
        distinct.alias("distinct_count"),
        F.coalesce(F.sum(F.when(value != text.strip(value), n)), F.lit(0))
        .alias("whitespace_dirty_count"),
    )
    return _told(profile.withColumn("label", F.get(labels, F.col("number"))).select("label.*", "*"))


def _told(profile: DataFrame) -> DataFrame:
    percent = 100.0 * F.col("null_count") / F.col("row_count")
    return profile.select(
        "table", "column", "row_count", "null_count", round_half_even(percent, 2).alias("null_pct"),
        "distinct_count", "whitespace_dirty_count")


#: Distinct values are estimated from 2 ** SKETCH_BITS registers; the relative standard error is
#: 1.04 / 2 ** (SKETCH_BITS / 2), which is 1.6 %.
SKETCH_BITS = 12


def column_sketches(frames: Frames, bits: int = SKETCH_BITS) -> DataFrame:
    """What a profile of one load leaves for later ones: counts and a distinct-value sketch by column.

    ``table, column, row_count, null_count, whitespace_dirty_count, sketch``. A task sends one row per
    column; no cell is shuffled.
    """
    cells, labels = _cells(frames)
    value = F.col("value")
    return cells.groupBy("number").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(value.isNull()).alias("null_count"),
        F.count_if(value != text.strip(value)).alias("whitespace_dirty_count"),
        F.hll_sketch_agg(value, F.lit(bits)).alias("sketch"),
    ).withColumn("label", F.get(labels, F.col("number"))).select(
        "label.*", "row_count", "null_count", "whitespace_dirty_count", "sketch")


def merged_profile(sketches: DataFrame) -> DataFrame:
    """``column_profile`` over all loads that left sketches, without reading their rows.

    Counts are exact, ``distinct_count`` is an estimate (``SKETCH_BITS``).
    """
    return _told(sketches.groupBy("table", "column").agg(
        *[F.sum(c).alias(c) for c in ("row_count", "null_count", "whitespace_dirty_count")],
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count")))


def null_offenders(profile: DataFrame) -> DataFrame:
    return profile.filter("null_count > 0").orderBy(F.desc("null_count"), "table", "column")


def duplicate_checks(
    frames: Frames, checks: Sequence[tuple[str, tuple[str, ...]]] = DUPLICATE_CHECKS
) -> DataFrame:
    """Rows that repeat an earlier key, per check."""
    def label(table: str, keys: tuple[str, ...]) -> str:
        return f"{table}.{keys[0] if len(keys) == 1 else '(' + ', '.join(keys) + ')'} duplicated"

    return union_all([
        keyed.surplus_count(frames[table], keys)
        .select(F.lit(label(table, keys)).alias("check"), "violation_count")
        for table, keys in checks
    ])


def reference_checks(frames: Frames, references: Sequence[Reference] = REFERENCES) -> DataFrame:
    """Rows whose key has no parent, per reference. Counted on distinct keys."""
    def check(ref: Reference) -> DataFrame:
        child = frames[ref.child]
        if ref.skip_nulls:
            child = child.filter(F.col(ref.column).isNotNull())
        keys = keyed.missing_keys(child, F.col(ref.column),
                                  frames[ref.parent], F.col(ref.parent_column))
        missing = F.sum(F.when(F.col("found").isNull(), F.col("n")))
        return keys.agg(F.coalesce(missing, F.lit(0)).alias("violation_count")).select(
            F.lit(ref.label).alias("check"), "violation_count")

    return union_all([check(ref) for ref in references])


def prefix_distribution(products: DataFrame, key: str = "sku") -> DataFrame:
    """Key prefixes, most frequent first."""
    return (
        products.groupBy(text.leading_letters(F.col(key)).alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "prefix")
    )


def date_violations(frames: Frames, formats: DateFormats = DATE_FORMATS) -> DataFrame:
    """One row per value that is not a date of its column's format; one scan per table."""
    def of_table(table: str, columns: Mapping[str, str]) -> DataFrame:
        bad = [
            F.when(
                dates.parse_fails(F.col(c), fmt),
                F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"),
                         F.lit(fmt).alias("expected_format"), F.col(c).alias("raw_value")),
            )
            for c, fmt in columns.items()
        ]
        found = F.filter(F.array(*bad), lambda v: v.isNotNull())
        return frames[table].select(F.explode(found).alias("v")).select("v.*")

    return union_all([of_table(t, columns) for t, columns in formats.items()])


def date_violation_counts(frames: Frames, formats: DateFormats = DATE_FORMATS) -> DataFrame:
    """Off-format values per date column, zeros included; one scan per table."""
    def of_table(table: str, columns: Mapping[str, str]) -> DataFrame:
        counts = frames[table].agg(
            *[F.count_if(dates.parse_fails(F.col(c), f)).alias(c) for c, f in columns.items()]
        )
        long = counts.unpivot([], list(columns), "column", "violation_count")
        return long.select(F.lit(table).alias("table"), "column", "violation_count")

    return union_all([of_table(t, columns) for t, columns in formats.items()])
