"""The jobs a user runs: load, profile, assess, standardize and report.

Each phase reads tables that an earlier phase wrote, so nothing is computed twice and a lost
executor costs at most the tasks it held.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritable.functions.dates import register_sql_functions
from veritable.operators import evaluate, profile, report, rules, score, standardize
from veritable.sources import raw
from veritable.sources.schemas import ENTITIES, Entity
from veritable.sources.scratch import written
from veritable.sources.tables import Store, TooManyRejects, write_csv


def prepare(store: Store) -> None:
    """Databases, tables and views of earlier sessions, and the SQL functions."""
    store.recover()
    store.create_layers()
    register_sql_functions(store.spark)
    register_sql_functions(store.spark, "governance")
    store.restore()


def load(
    spark: SparkSession, store: Store, paths: Mapping[str, str], mode: str = "overwrite",
    multi_line: bool = False, parse_mode: str = "PERMISSIVE", max_rejected: float | None = 0,
    numbered: bool = False, check_keys: bool = False,
) -> DataFrame:
    """CSV files → raw tables. Returns rows per table. The scan's options are those of ``read_csv``.

    A line that would lose cells goes to ``governance.raw_rejects`` with its reasons, in the pass that
    stores the other lines. More such lines in a file set than ``max_rejected`` (a share if below 1,
    any number if None) stop the run before that table is touched. ``numbered`` adds ``row_number``,
    the place of a line in its files (``raw.number_rows``). ``check_keys`` refuses an appended load
    that has a key of an earlier load, or one key twice, and keeps the keys for the next one.
    """
    if parse_mode != "PERMISSIVE":
        return store.write_raw(raw.read_all(spark, paths, multi_line, parse_mode), mode)
    rows = {}
    for name, path in paths.items():
        entity = ENTITIES[name]
        schema = entity.raw_schema
        before = store.stored_rows("raw", name) if mode == "append" else 0
        lines = raw.read_lines(spark, path, schema, multi_line)
        columns = {c: F.col(c) for c in schema.names}
        if numbered:
            lines = raw.number_rows(lines, None if isinstance(path, str) else path)
            columns["row_number"] = F.col("row_number")
        faults = raw.line_faults(schema)
        if check_keys and mode == "append":
            lines = written(lines, "load")  # its keys are looked at before it is stored
            fresh = lines.where(F.size(faults) == 0).select(*entity.key)
            store.assert_new_keys(fresh, name, entity.key)
        split = store.write_split(
            lines, "raw", name, faults, "raw_rejects", columns, max_rejected, mode)
        if check_keys and mode == "append":
            store.append_keys(fresh, name, entity.key)
        elif check_keys:
            store.replace_keys(split.accepted, name, entity.key)
        rows[name] = before + split.counts["rows"] - split.counts["rejected"]
    return store.row_counts(rows)


def raw_frames(store: Store, numbered: bool = False) -> dict[str, DataFrame]:
    """The raw tables, with the ``row_number`` of a numbered load if asked for."""
    def schema(entity: Entity) -> T.StructType:
        return entity.raw_schema.add("row_number", "long") if numbered else entity.raw_schema

    return {name: store.read("raw", name, schema(e)) for name, e in ENTITIES.items()}


def now() -> dt.datetime:
    """The time of a run, which is the same for drivers in any zone."""
    return dt.datetime.now(dt.timezone.utc)


def _write_reports(tables: Mapping[str, DataFrame], folder: str | None) -> None:
    """CSV copies of result tables, for those who want them."""
    if folder:
        for name, df in tables.items():
            write_csv(df, f"{folder}/{name}")


def run_profile(store: Store, reports: str | None = None) -> dict[str, DataFrame]:
    """Raw tables → profiling tables."""
    frames = raw_frames(store)
    tables = {
        "profiling_column_summary": profile.column_profile(frames),
        "profiling_duplicate_checks": profile.duplicate_checks(frames),
        "profiling_fk_checks": profile.reference_checks(frames),
        "profiling_prefix_distribution": profile.prefix_distribution(frames["products"]),
        "profiling_date_format_violations": profile.date_violations(frames),
        "profiling_date_format_counts": profile.date_violation_counts(frames),
    }
    out = {n: store.write(df, "governance", n) for n, df in tables.items()}
    out["profiling_null_offenders"] = profile.null_offenders(out["profiling_column_summary"])
    _write_reports(out, reports)
    return out


def profile_load(
    store: Store, frames: Mapping[str, DataFrame], load: str, bits: int = profile.SKETCH_BITS,
) -> DataFrame:
    """Profile one load and return the profile of all loads so far.

    Only ``frames``, the rows of this load, are read; earlier loads come in as the sketches that they
    left in ``governance.profile_sketches``. A load that is profiled again replaces its own sketches.
    """
    fresh = profile.column_sketches(frames, bits).withColumn("load", F.lit(load)).coalesce(1)
    return profile.merged_profile(
        store.write_parts(fresh, "governance", "profile_sketches", ["load"]))


def run_assess(
    store: Store, reports: str | None = None, ruleset: str = "sql",
    measured_at: dt.datetime | None = None, file_order: bool = False,
) -> dict[str, DataFrame]:
    """Raw tables → violations log → scorecards.

    The ``sql`` rules also get their views and add a snapshot to the score history; views
    ``governance.v_...`` that users added take part in log and scores. Tables of another rule set
    carry its name, so that neither run replaces the other's results. After a numbered
    load, ``file_order`` lets the ``cell`` rules take the product that comes first in the files as
    the first of several equal ones.
    """
    frames, exact = raw_frames(store, file_order), ruleset == "sql"
    catalog = rules.RULESETS[ruleset]() if not file_order else rules.cell_rules(F.col("row_number"))
    if file_order and exact:
        raise ValueError("the sql rules have no first record")
    suffix = "" if exact else f"_{ruleset}"
    views = {}
    if exact and store.register:
        own = {rules.view_name(r) for r in catalog}
        views = evaluate.catalog_views(store.spark, "governance", without=own)
        store.remember_views(views)
    log = store.write_log(evaluate.whole_log(frames, catalog, views), f"violations_log{suffix}")
    rows = store.write(score.row_counts(frames), "governance", "table_row_counts")
    card = store.write(
        score.scorecard_from_log(log, rows, exact), "governance", f"quality_scorecard{suffix}")
    rollup = score.domain_scorecard if exact else score.cell_domain_scorecard
    domains = store.write(rollup(card), "governance", f"quality_scorecard_domain{suffix}")
    if exact:
        evaluate.create_rule_views(frames, catalog)
        store.create_rule_views(catalog)
        snapshot = score.history_snapshot(card, measured_at or now())
        store.append_history(snapshot)
    out = {"violations_log": log if exact else evaluate.cell_log(log),
           "quality_scorecard": score.ordered(card), "quality_scorecard_domain": domains}
    _write_reports({f"{name}{suffix}": df for name, df in out.items()}, reports)
    return {**out, "table_row_counts": rows}


def run_standardize(
    store: Store, reports: str | None = None, max_rejected: float | None = 0,
) -> dict[str, DataFrame]:
    """Raw tables → audit tables with raw and clean columns → typed staging tables.

    Key collisions of the prefix rewrite stop the run. Rows with a broken primary key, or with a value
    that its staging type would lose or round, go to ``governance.staging_rejects`` with all reasons,
    in the pass that stores the other rows; more of them in a table than ``max_rejected`` (a share if
    below 1, any number if None) stop the run before that staging table is touched. Counters of issues
    and of lost values come from the jobs that write.
    """
    frames, spark = raw_frames(store), store.spark
    audit = {"products": standardize.standardize_products(frames["products"])}
    standardize.assert_no_collisions(audit["products"])
    for table in standardize.DATE_FALLBACKS:
        audit[table] = standardize.standardize_table_dates(frames[table], table)
    counted = []
    for table, df in audit.items():
        issues = report.issues_of(table)
        audit[table], values = store.write_counted(
            df, "governance", f"staging_{table}", report.issue_metrics(issues))
        counted.append((issues, values))

    final = {"products": standardize.final_products(audit["products"])}
    for table in standardize.DATE_FALLBACKS:
        final[table] = standardize.final_dates(audit[table], table)
    out: dict[str, DataFrame] = {}
    lost: list[tuple] = []
    try:
        for table, df in final.items():
            out[table] = _stage(store, table, df, max_rejected, lost)
    finally:
        out["staging_lost_casts"] = store.write(
            spark.createDataFrame(lost, "table_name string, column string, lost long"),
            "governance", "staging_lost_casts")
    _write_reports({f"staging_{t}": df for t, df in audit.items()}, reports)
    _write_reports({"staging_products_final": final["products"]}, reports)
    out["staging_rejects"] = store.rejects("staging_rejects", standardize.STAGING_REJECTS)
    out["remediation_summary"] = store.write(
        report.summary_of_metrics(spark, counted), "governance", "remediation_summary")
    return out


def _stage(
    store: Store, table: str, df: DataFrame, max_rejected: float | None, lost: list[tuple],
) -> DataFrame:
    """One staging table and its rejects; what its types would lose is added to ``lost``."""
    entity = ENTITIES[table]
    unique = table in standardize.PRIMARY_KEYS
    counts = {}
    try:
        split = store.write_split(
            standardize.with_repeats(df, entity, unique), "staging", table,
            standardize.staging_faults(df, entity, unique), "staging_rejects",
            standardize.staged_columns(entity), max_rejected,
            metrics={f"lost_{c}": n for c, n in standardize.lost_counts(df, entity).items()})
        counts = split.counts
    except TooManyRejects as error:
        counts = error.counts
        raise
    finally:
        lost += [(table, c, counts[f"lost_{c}"]) for c in entity.typed if f"lost_{c}" in counts]
    return split.accepted


def run_report(store: Store, reports: str | None = None) -> dict[str, DataFrame]:
    """The report's tables, from what ``run_assess`` (exact rules) and ``run_standardize`` wrote."""
    def stored(name: str) -> DataFrame:
        return store.read("governance", name)

    card, rows = stored("quality_scorecard"), stored("table_row_counts")
    tables = {
        "report_composition": report.composition(card),
        "report_prevalence": report.prevalence(card, rows),
        "report_heatmap": report.heatmap(card),
        "report_trend": score.score_trend(stored("quality_scorecard_history")),
        "report_review_queue": report.review_queue(
            raw_frames(store), stored("staging_products"), rules.sql_rules()),
        "report_headline": report.headline(card, rows, stored("remediation_summary")),
    }
    out = {n: store.write(df, "governance", n) for n, df in tables.items()}
    _write_reports(out, reports)
    return out
