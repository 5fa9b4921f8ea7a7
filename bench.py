"""Time the headline queries and print one JSON line.

Each query runs to a sink that discards its rows. A small run first loads the classes that any
first query would pay for. ``build`` is the part of a query's time that passes before its result is
asked for: setting up the plan, and the tables that a query writes on its way.
"""

from __future__ import annotations

import json
import os
import time

from veritable.plans.queries import QUERIES
from veritable.session import build_session

HEADLINE = (
    "scorecard_domain", "scorecard", "violations_log", "cell_log", "cell_domain",
    "column_profile", "duplicate_checks", "fk_checks", "date_violations",
    "rule_uniqueness", "surplus_duplicates", "rule_orphan_supplier",
    "staging_products_final", "staging_typed_po", "staging_typed_inventory",
    "remediation_summary", "review_queue", "drillthrough", "sink_roundtrip",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["scorecard"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds, build = {}, {}
    for name in HEADLINE:
        start = time.perf_counter()
        result = QUERIES[name](spark, sf_dir)
        build[name] = round(time.perf_counter() - start, 3)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "build": build,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
