"""Evaluation of rule specs: the violations log, and counts without a log."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.operators import keyed
from veritable.operators.rules import ForeignKeyRule, RowRule, Rule, UniqueRule, view_name

Frames = Mapping[str, DataFrame]

LOG_COLUMNS = ("record_id", "table_name", "dimension", "rule_name", "detail")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _row_rules_by_table(rules: Sequence[Rule]) -> dict[str, list[RowRule]]:
    tables: dict[str, list[RowRule]] = {}
    for rule in rules:
        if isinstance(rule, RowRule):
            tables.setdefault(rule.table, []).append(rule)
    return tables


# --- violations, one row each ---------------------------------------------------------


def _with_derived(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """What several rules read is computed once: Spark keeps costly columns that are used again."""
    derived = dict(pair for r in rules for pair in r.derived)
    return df.withColumns(derived) if derived else df


def _row_violations(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """All row rules of a table in one scan, without a shuffle."""
    found = [
        F.when(
            r.violated,
            F.struct(
                F.col(r.record_id).alias("record_id"),
                F.lit(r.table).alias("table_name"),
                F.lit(r.dimension).alias("dimension"),
                F.lit(r.name).alias("rule_name"),
                r.detail.alias("detail"),
            ),
        )
        for r in rules
    ]
    broken = F.filter(F.array(*found), lambda v: v.isNotNull())
    return _with_derived(df, rules).select(F.explode(broken).alias("v")).select("v.*")


def _tagged(ids: DataFrame, rule: Rule, detail) -> DataFrame:
    return ids.select(
        F.col(rule.record_id).alias("record_id"),
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.dimension).alias("dimension"),
        F.lit(rule.name).alias("rule_name"),
        detail.alias("detail"),
    )


def _unique_violations(df: DataFrame, rule: UniqueRule) -> DataFrame:
    if rule.surplus_only:
        order = rule.order if rule.order is not None else F.col(rule.record_id)
        ids = keyed.surplus(df, rule.keys, rule.record_id, order)
    else:
        ids = keyed.duplicated(df, rule.keys, rule.record_id)
    return _tagged(ids, rule, F.lit(rule.detail))


def _orphans(df: DataFrame, parent: DataFrame, rule: ForeignKeyRule) -> DataFrame:
    """A plain anti-join: both inputs are table scans, so a hot key can be split at run time."""
    parents = parent.select(rule.normalized(F.col(rule.parent_column)).alias("_parent"))
    children = df.select(rule.record_id, rule.column).filter(F.col(rule.column).isNotNull())
    missing = children.join(
        parents, rule.normalized(F.col(rule.column)) == F.col("_parent"), "left_anti"
    )
    return _tagged(missing, rule, rule.detail)


def rule_violations(frames: Frames, rule: Rule) -> DataFrame:
    """The violations of one rule."""
    df = frames[rule.table]
    if isinstance(rule, UniqueRule):
        return _unique_violations(df, rule)
    if isinstance(rule, ForeignKeyRule):
        return _orphans(df, frames[rule.parent], rule)
    return _row_violations(df, [rule])


def violations_log(frames: Frames, rules: Sequence[Rule]) -> DataFrame:
    """One row per violation. Each table is scanned once for all its row rules."""
    parts = [_row_violations(frames[t], rs) for t, rs in _row_rules_by_table(rules).items()]
    parts += [rule_violations(frames, r) for r in rules if not isinstance(r, RowRule)]
    return union_all(parts)


def cell_log(log: DataFrame) -> DataFrame:
    """The narrow log: table, dimension and record only."""
    return log.select("table_name", "dimension", "record_id")


def create_rule_views(frames: Frames, rules: Sequence[Rule]) -> list[str]:
    """One temporary view per rule, which evaluates the rule whenever it is queried."""
    names = []
    for rule in rules:
        name = view_name(rule)
        rule_violations(frames, rule).createOrReplaceTempView(name)
        names.append(name)
    return names


# --- rules that users add as views -------------------------------------------------------


def catalog_views(spark: SparkSession, database: str, pattern: str = "v_*",
                  without: Collection[str] = ()) -> dict[str, DataFrame]:
    """The views of a name pattern that are rules, by name: those with the columns of the log.

    Views of the session count, too. ``without`` names the views of rules that are evaluated anyway.
    A view of another shape is refused, since it would silently be missing from every score.
    """
    found = {}
    for table in spark.catalog.listTables(database, pattern):
        if table.name in without or table.tableType not in ("VIEW", "TEMPORARY"):
            continue
        name = table.name if table.isTemporary else f"{database}.{table.name}"
        view = spark.table(name)
        if sorted(view.columns) != sorted(LOG_COLUMNS):
            raise ValueError(f"view {name} has columns {view.columns}, not those of the log: "
                             f"{list(LOG_COLUMNS)}")
        found[name] = view.select([F.col(c).cast("string").alias(c) for c in LOG_COLUMNS])
    return found


def whole_log(frames: Frames, rules: Sequence[Rule], views: Mapping[str, DataFrame]) -> DataFrame:
    """The log of the built-in rules and of the rules found as views."""
    return union_all([violations_log(frames, rules), *views.values()])


# --- counts, for scores ---------------------------------------------------------------


def _unpivot_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row holding ``rows`` and ``c0, c1, ...`` → one row per rule."""
    per_rule = [
        F.struct(
            F.lit(r.table).alias("table_name"),
            F.lit(r.dimension).alias("dimension"),
            F.lit(r.name).alias("rule_name"),
            F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("violation_count"),
            F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("row_count"),
        )
        for i, r in enumerate(rules)
    ]
    return df.select(F.inline(F.array(*per_rule)))


def _count_row_rules(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    counts = [F.count_if(r.violated).alias(f"c{i}") for i, r in enumerate(rules)]
    counted = _with_derived(df, rules).agg(F.count(F.lit(1)).alias("rows"), *counts)
    return _unpivot_counts(counted, rules)


def _count_unique(df: DataFrame, rule: UniqueRule) -> DataFrame:
    bad = F.col("n") - 1 if rule.surplus_only else F.when(F.col("n") > 1, F.col("n"))
    sizes = keyed.group_sizes(df, rule.keys)
    return _unpivot_counts(sizes.agg(F.sum("n").alias("rows"), F.sum(bad).alias("c0")), [rule])


def _count_orphans(df: DataFrame, parent: DataFrame, rule: ForeignKeyRule) -> DataFrame:
    keys = keyed.missing_keys(
        df, rule.normalized(F.col(rule.column)),
        parent, rule.normalized(F.col(rule.parent_column)),
    )
    bad = F.when(~F.col("no_key") & F.col("found").isNull(), F.col("n"))
    return _unpivot_counts(keys.agg(F.sum("n").alias("rows"), F.sum(bad).alias("c0")), [rule])


def violation_counts(frames: Frames, rules: Sequence[Rule]) -> DataFrame:
    """Violations and table rows by rule, without building the log.

    Scores need only counts, so duplicates and orphans are counted on distinct keys: no row is
    joined back and no detail text is made.
    """
    parts = [_count_row_rules(frames[t], rs) for t, rs in _row_rules_by_table(rules).items()]
    for rule in rules:
        if isinstance(rule, UniqueRule):
            parts.append(_count_unique(frames[rule.table], rule))
        elif isinstance(rule, ForeignKeyRule):
            parts.append(_count_orphans(frames[rule.table], frames[rule.parent], rule))
    return union_all(parts)
