"""Scores by table and dimension, their rollup by table, and the score history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritable.functions.numbers import round_half_even, round_half_up, share
from veritable.operators.evaluate import Frames, union_all


def row_counts(frames: Frames) -> DataFrame:
    """Rows per table, the denominator of every score."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ])


def _exact_score(violations: Column, rows: Column) -> Column:
    return round_half_up(F.lit(1) - share(violations, rows), 4)


def _double_score(violations: Column, rows: Column) -> Column:
    return round_half_even(F.lit(1.0) - violations / F.nullif(rows, F.lit(0)), 4)


def _scored(counts: DataFrame, exact: bool) -> DataFrame:
    score = _exact_score if exact else _double_score
    return counts.select(
        "table_name", "dimension", "violation_count", "row_count",
        score(F.col("violation_count"), F.col("row_count")).alias("quality_score"),
    )


def scorecard_from_log(log: DataFrame, rows: DataFrame, exact: bool = True) -> DataFrame:
    """``1 - violations / rows`` by (table, dimension), from a violations log.

    Pairs without a violation have no row. A score may be negative, since one record can break
    several rules of a dimension. ``rows`` has one row per table, hence the broadcast.
    """
    found = log.groupBy("table_name", "dimension").agg(
        F.count(F.lit(1)).alias("violation_count"))
    return _scored(found.join(F.broadcast(rows), "table_name"), exact)


def scorecard(counts: DataFrame, exact: bool = True) -> DataFrame:
    """The same scorecard from ``evaluate.violation_counts``, which needs no log and no join."""
    found = counts.groupBy("table_name", "dimension").agg(
        F.sum("violation_count").alias("violation_count"), F.max("row_count").alias("row_count"))
    return _scored(found.filter("violation_count > 0"), exact)


def ordered(card: DataFrame) -> DataFrame:
    return card.orderBy("table_name", "dimension")


def worst_scores(card: DataFrame) -> DataFrame:
    return card.orderBy("quality_score", "table_name", "dimension")


def domain_scorecard(card: DataFrame) -> DataFrame:
    """Mean of the rounded scores of the dimensions present, worst table first."""
    return (
        card.groupBy(F.col("table_name").alias("domain"))
        .agg(round_half_up(F.avg("quality_score"), 4).alias("overall_score"),
             F.sum("violation_count").alias("total_violations"))
        .orderBy("overall_score", "domain")
    )


def cell_domain_scorecard(card: DataFrame) -> DataFrame:
    """The unrounded mean, on doubles summed in dimension order so that it is repeatable."""
    by_dimension = F.array_sort(F.collect_list(F.struct("dimension", "quality_score")))
    total = F.aggregate(by_dimension, F.lit(0.0), lambda acc, s: acc + s["quality_score"])
    return (
        card.groupBy("table_name")
        .agg((total / F.count(F.lit(1))).alias("overall_score"),
             F.sum("violation_count").alias("total_violations"))
        .orderBy("overall_score", "table_name")
    )


def history_snapshot(card: DataFrame, measured_at: dt.datetime) -> DataFrame:
    """A scorecard as rows of the history table. The time is an argument, so runs repeat.

    A time without a zone is in the session's zone.
    """
    when = F.lit(measured_at.isoformat(sep=" ")).cast("timestamp")
    return card.select(
        when.alias("measured_at"), "table_name", "dimension",
        "violation_count", "row_count", "quality_score",
    )


def score_trend(history: DataFrame) -> DataFrame:
    """Each score next to the one before it. A group holds one row per snapshot."""
    runs = Window.partitionBy("table_name", "dimension").orderBy("measured_at")
    previous = F.lag("quality_score").over(runs)
    return history.select(
        "measured_at", "table_name", "dimension", "quality_score",
        previous.alias("previous_score"), (F.col("quality_score") - previous).alias("change"),
    )
