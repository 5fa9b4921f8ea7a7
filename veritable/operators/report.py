"""The tables behind the quality report and its dashboard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritable.functions import dates, text
from veritable.functions.numbers import round_half_up, share
from veritable.operators import keyed
from veritable.operators.evaluate import Frames, rule_violations, union_all
from veritable.operators.rules import ForeignKeyRule, Rule, UniqueRule
from veritable.operators.score import domain_scorecard
from veritable.operators.standardize import DATE_FALLBACKS

# The five quality dimensions.
DIMENSIONS = ("completeness", "uniqueness", "validity", "consistency", "accuracy")


def dimension_counts(card: DataFrame) -> DataFrame:
    """Violations by dimension, most frequent first."""
    return (
        card.groupBy("dimension").agg(F.sum("violation_count").alias("violation_count"))
        .orderBy(F.desc("violation_count"), "dimension")
    )


def _percent(part, whole):
    return round_half_up(100 * share(part, whole), 2)


def composition(card: DataFrame) -> DataFrame:
    """Share of all violations by dimension. The window spans one row per dimension."""
    total = F.sum("violation_count").over(Window.partitionBy())
    return dimension_counts(card).select(
        "dimension", "violation_count",
        _percent(F.col("violation_count"), total).alias("pct_of_violations"))


def prevalence(card: DataFrame, rows: DataFrame) -> DataFrame:
    """Violations by dimension against the rows of all tables."""
    total = rows.agg(F.sum("row_count")).scalar()
    return dimension_counts(card).withColumn("total_rows", total).select(
        "dimension", "violation_count", "total_rows",
        _percent(F.col("violation_count"), F.col("total_rows")).alias("prevalence_pct"))


def heatmap(card: DataFrame) -> DataFrame:
    """Scores as a table × dimension grid; a dimension without violations is NULL."""
    return card.groupBy("table_name").pivot("dimension", list(DIMENSIONS)).agg(
        F.first("quality_score"))


def top_category(card: DataFrame) -> DataFrame:
    return dimension_counts(card).limit(1)


def drill_through(
    log: DataFrame, source: DataFrame, record_id: str, table: str, dimension: str
) -> DataFrame:
    """The broken records behind one score, with the rules each one breaks.

    The log is reduced to one row per record first, so a record that breaks several rules, or
    an id that several rows share, does not multiply rows.
    """
    wanted = log.filter((F.col("table_name") == table) & (F.col("dimension") == dimension))
    broken = wanted.groupBy(F.col("record_id").alias(record_id)).agg(
        F.array_join(F.array_sort(F.collect_set("rule_name")), ", ").alias("rules"))
    return keyed.attach(source, broken, [record_id], "inner")


def record_violations(log: DataFrame, table: str, record_id: str) -> DataFrame:
    """What is wrong with one record. On a stored log only the folders of its table are looked at, and in
    them only row groups whose statistics and Bloom filter admit the record."""
    return log.where((F.col("table_name") == table) & (F.col("record_id") == record_id))


Issues = Mapping[str, tuple[Column, Column]]


def issues_of(table: str) -> Issues:
    """Per kind of issue of an audited table: which rows have it, and which of these are resolved."""
    if table == "products":
        return {
            "non-canonical category": (
                text.differs_from_title(F.col("category")),
                ~text.differs_from_title(F.col("category_clean")),
            ),
            "null category": (F.col("category").isNull(), F.col("category_clean").isNotNull()),
            "non-standard sku prefix": (
                F.col("sku") != F.col("sku_clean"), F.col("sku_clean").isNotNull()),
            "null price": (F.col("price").isNull(), F.col("price_clean").isNotNull()),
        }
    return {
        f"malformed {c}": (
            dates.parse_fails(F.col(c), fmts[0]), dates.parse_first(F.col(c), fmts).isNotNull())
        for c, fmts in DATE_FALLBACKS[table].items()
    }


def issue_metrics(issues: Issues) -> dict[str, Column]:
    """Counters of the issues: rows affected ``a0, a1, ...`` and resolved ``r0, r1, ...``."""
    out = {}
    for i, (affected, resolved) in enumerate(issues.values()):
        out |= {f"a{i}": F.count_if(affected), f"r{i}": F.count_if(affected & resolved)}
    return out


def summary_of_metrics(spark: SparkSession, counted: Sequence[tuple[Issues, Mapping[str, int]]]
                       ) -> DataFrame:
    """The remediation summary from counters that the writes of the audit tables took."""
    rows = [(issue, values[f"a{i}"], values[f"r{i}"], values[f"a{i}"] - values[f"r{i}"])
            for issues, values in counted for i, issue in enumerate(issues)]
    return spark.createDataFrame(
        rows, "issue string, affected long, resolved long, unresolved long")


def remediation_summary(audit: DataFrame, frames: Frames) -> DataFrame:
    """Per kind of issue: records affected, resolved and left. One scan per table."""
    parts = [_issues(audit, issues_of("products"))]
    parts += [_issues(frames[table], issues_of(table)) for table in DATE_FALLBACKS]
    return union_all(parts)


def _issues(df: DataFrame, issues: Issues) -> DataFrame:
    rows = [
        F.struct(
            F.lit(issue).alias("issue"), F.col(f"a{i}").alias("affected"),
            F.col(f"r{i}").alias("resolved"),
            (F.col(f"a{i}") - F.col(f"r{i}")).alias("unresolved"),
        )
        for i, issue in enumerate(issues)
    ]
    return df.agg(*[c.alias(n) for n, c in issue_metrics(issues).items()]).select(
        F.inline(F.array(*rows)))


def review_queue(frames: Frames, audit: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Records for a person to decide: orphans, duplicates and categories nothing could infer."""
    by_hand = [r for r in rules if isinstance(r, (UniqueRule, ForeignKeyRule))]
    parts = [
        rule_violations(frames, r).select(
            "record_id", F.col("rule_name").alias("reason"), "detail")
        for r in by_hand
    ]
    untagged = audit.filter(F.col("category_clean").isNull()).select(
        F.col("sku").alias("record_id"), F.lit("category_not_inferable").alias("reason"),
        F.concat(F.lit('product_name = "'), F.col("product_name"), F.lit('"')).alias("detail"))
    return union_all([*parts, untagged])


def headline(card: DataFrame, rows: DataFrame, remediation: DataFrame) -> DataFrame:
    """The report's key figures in one row.

    Each input is a small result table and is looked up a few times, so pass written tables.
    """
    def score_of(table: str):
        score = F.max(F.when(F.col("domain") == table, F.col("overall_score")))
        return score.alias(f"{table}_score")

    def issues(pattern: str, measure: str):
        return F.sum(F.when(F.col("issue").like(pattern), F.col(measure)))

    violations = card.agg(
        F.sum("violation_count").alias("total"), F.count_distinct("dimension").alias("dimensions"))
    scored = ("products", "purchase_orders", "inventory_transactions")
    scores = domain_scorecard(card).agg(*[score_of(t) for t in scored])
    top = composition(card).agg(
        F.max_by("dimension", "violation_count").alias("dimension"),
        F.max("pct_of_violations").alias("pct"))
    fixed = remediation.agg(
        issues("non-standard sku prefix", "resolved").alias("skus"),
        issues("malformed %", "affected").alias("malformed"),
        issues("malformed %", "resolved").alias("recovered"))
    tables = rows.agg(
        F.count(F.lit(1)).alias("tables_assessed"), F.sum("row_count").alias("total_rows"))

    def one_row(df: DataFrame, name: str):
        return df.select(F.struct("*").alias(name)).scalar().alias(name)

    return tables.select(
        "tables_assessed", "total_rows", one_row(violations, "v"), one_row(scores, "s"),
        one_row(top, "t"), one_row(fixed, "f"),
    ).select(
        F.col("v.total").alias("total_violations"), "tables_assessed", "total_rows",
        "v.dimensions", F.col("f.skus").alias("skus_standardized"),
        F.col("f.malformed").alias("malformed_dates"),
        F.col("f.recovered").alias("dates_recovered"),
        *[f"s.{t}_score" for t in scored],
        F.col("t.dimension").alias("largest_dimension"),
        F.col("t.pct").alias("largest_dimension_pct"),
    )
