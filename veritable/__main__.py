"""Run a phase: ``python -m veritable {load,profile,assess,standardize,report,all} --data D --root R``."""

from __future__ import annotations

import argparse

from veritable.plans import phases
from veritable.session import build_session
from veritable.sources.raw import default_paths
from veritable.sources.tables import Store

PHASES = ["load", "profile", "assess", "standardize", "report"]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="veritable")
    parser.add_argument("phase", choices=[*PHASES, "all"])
    parser.add_argument("--data", required=True, help="folder of the erp_*.csv files")
    parser.add_argument("--root", required=True, help="folder of the tables, shared by executors")
    parser.add_argument("--csv", action="store_true", help="also write results as CSV reports")
    parser.add_argument("--ruleset", choices=["sql", "cell"], default="sql")
    parser.add_argument("--append", action="store_true", help="add to the raw tables")
    parser.add_argument("--multi-line", action="store_true", help="quoted cells hold line breaks")
    parser.add_argument("--strict", action="store_true", help="refuse lines of another length")
    parser.add_argument("--max-rejected", type=float, default=0,
                        help="rows a table may reject (a share if below 1, any number if negative)")
    args = parser.parse_args(argv)
    allowed = None if args.max_rejected < 0 else args.max_rejected

    spark = build_session("veritable")
    store = Store(spark, args.root)
    reports = f"{args.root.rstrip('/')}/reports" if args.csv else None
    phases.prepare(store)
    wanted = PHASES if args.phase == "all" else [args.phase]
    if "load" in wanted:
        phases.load(
            spark, store, default_paths(args.data), "append" if args.append else "overwrite",
            args.multi_line, "FAILFAST" if args.strict else "PERMISSIVE", allowed).show(truncate=False)
    if "profile" in wanted:
        tables = phases.run_profile(store, reports)
        for name in ("null_offenders", "duplicate_checks", "fk_checks", "prefix_distribution",
                     "date_format_counts"):
            tables[f"profiling_{name}"].show(truncate=False)
    if "assess" in wanted:
        tables = phases.run_assess(store, reports, args.ruleset)
        tables["quality_scorecard"].show(truncate=False)
        tables["quality_scorecard_domain"].show(truncate=False)
    if "standardize" in wanted:
        phases.run_standardize(store, reports, allowed)["remediation_summary"].show(truncate=False)
    # The report is drawn from the exact rules' tables.
    if "report" in wanted and (args.phase == "report" or args.ruleset == "sql"):
        phases.run_report(store, reports)["report_headline"].show(truncate=False, vertical=True)


if __name__ == "__main__":
    main()
