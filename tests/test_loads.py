"""Loads after the first one: row numbers, keys, sketches, snapshots, rules added as views, look-ups."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_phases import CSV, data_dir, store  # noqa: F401
from veritable.operators import evaluate, profile, report, rules, standardize
from veritable.plans import phases
from veritable.sources import raw
from veritable.sources.schemas import ENTITIES

PRODUCTS = ENTITIES["products"].raw_schema
LOG = "record_id string, table_name string, dimension string, rule_name string, detail string"


def product_lines(n, seed):
    rng = random.Random(seed)
    return [f"SKU{rng.randrange(10**6)},name {rng.randrange(60)},Tools,1,S{rng.randrange(5)}"
            for _ in range(n)]


@pytest.fixture
def product_files(tmp_path):
    """Files whose names do not follow their order, with keys in no order."""
    paths = []
    for name, n, seed in (("z.csv", 900, 1), ("a.csv", 1200, 2), ("m.csv", 1, 3), ("e.csv", 0, 4)):
        lines = [",".join(PRODUCTS.names), *product_lines(n, seed)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        paths.append(str(tmp_path / name))
    return paths


def test_rows_are_numbered_as_they_stand_in_the_files(spark, product_files, settings):
    settings(**{"files.maxPartitionBytes": "4096", "files.openCostInBytes": "0"})
    lines = raw.read_lines(spark, product_files, PRODUCTS)
    assert lines.rdd.getNumPartitions() > 8
    numbered = raw.number_rows(lines, product_files).orderBy("row_number")
    wanted = pd.concat([pd.read_csv(p, dtype=str) for p in product_files], ignore_index=True)
    got = numbered.select("row_number", *PRODUCTS.names).collect()
    assert [r.row_number for r in got] == list(range(len(wanted)))
    assert [tuple(r)[1:] for r in got] == list(wanted.itertuples(index=False, name=None))
    by_name = raw.number_rows(lines).orderBy("row_number").select("sku").collect()
    assert by_name[0].sku == pd.read_csv(sorted(product_files)[0], dtype=str).sku[0]


def test_surplus_rows_equal_pandas(spark, product_files, store, settings):  # noqa: F811
    settings(**{"files.maxPartitionBytes": "4096", "files.openCostInBytes": "0"})
    phases.load(spark, store, {"products": product_files}, numbered=True)
    frame = store.read("raw", "products")
    surplus = [r for r in rules.cell_rules(F.col("row_number")) if r.name.startswith("surplus_")]
    got = evaluate.violations_log({"products": frame}, surplus).select("record_id").collect()
    all_rows = pd.concat([pd.read_csv(p, dtype=str) for p in product_files], ignore_index=True)
    wanted = all_rows[all_rows.duplicated(["product_name", "supplier_id"], keep="first")].sku
    assert sorted(r.record_id for r in got) == sorted(wanted)
    assert store.read("raw", "products", PRODUCTS).columns == PRODUCTS.names


def test_the_cell_rules_follow_the_files(spark, data_dir, store, tmp_path):  # noqa: F811
    header = CSV["products"][0]
    (tmp_path / "erp_products.csv").write_text(
        "\n".join([header, "PRO9,Saw,Tools,1,S1", "PRO1,Saw,Tools,1,S1"]) + "\n")
    phases.load(spark, store, raw.default_paths(data_dir), numbered=True)
    for file_order, surplus in ((True, "PRO1"), (False, "PRO9")):
        phases.run_assess(store, ruleset="cell", file_order=file_order)
        log = store.read("governance", "violations_log_cell").where("dimension = 'uniqueness'")
        assert [r.record_id for r in log.collect()] == [surplus]
    with pytest.raises(ValueError, match="no first"):
        phases.run_assess(store, file_order=True)


def test_an_appended_load_with_a_known_key_stops(spark, data_dir, store, tmp_path, settings):  # noqa: F811
    paths = {"suppliers": f"{data_dir}/erp_suppliers.csv"}
    header = CSV["suppliers"][0]

    def load(*keys, mode="append"):
        lines = [header, *[f"{k},n,1,2" for k in keys]]
        (tmp_path / "erp_suppliers.csv").write_text("\n".join(lines) + "\n")
        return phases.load(spark, store, paths, mode, check_keys=True).first().row_count

    assert load("S1", "S2", mode="overwrite") == 2
    assert load("S3", "", "") == 5, "rows without a key do not clash"
    with pytest.raises(ValueError, match="stored already: .*S3"):
        load("S4", "S3")
    with pytest.raises(ValueError, match="twice: .*S5"):
        load("S5", "S5")
    assert store.read("raw", "suppliers").count() == 5, "as it was"
    spark.sql("DROP TABLE governance.keys_suppliers")  # another session finds the files again
    with pytest.raises(ValueError, match="stored already: .*S1"):
        load("S1")
    assert load("S3", mode="overwrite") == 1 and load("S1") == 2

    settings(autoBroadcastJoinThreshold="-1", **{"adaptive.autoBroadcastJoinThreshold": "-1"})
    fresh = spark.createDataFrame([("S1",), ("S9",)], "supplier_id string")
    known = store.known_keys(fresh, "suppliers", ["supplier_id"])
    assert known.collect() == [("S1",)]
    plan = known._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1, "new keys only"


def test_profiles_are_merged_without_old_rows(spark, store):  # noqa: F811
    schema = "sku string, size string"
    loads = [[(f"s{i % 700}", None if i % 3 else " x ") for i in range(2000)],
             [(f"s{i}", str(i % 7)) for i in range(5000)]]
    for k, rows in enumerate(loads):
        merged = phases.profile_load(store, {"t": spark.createDataFrame(rows, schema)}, f"l{k}")
    assert all("profile_sketches" in f for f in merged.inputFiles())
    merged = phases.profile_load(store, {"t": spark.createDataFrame(loads[1], schema)}, "l1")
    got = {r.column: r for r in merged.collect()}
    whole = spark.createDataFrame(loads[0] + loads[1], schema)
    for r in profile.column_profile({"t": whole}).collect():
        mine = got[r.column]
        assert (mine.row_count, mine.null_count, mine.null_pct, mine.whitespace_dirty_count) == (
            r.row_count, r.null_count, r.null_pct, r.whitespace_dirty_count)
        assert abs(mine.distinct_count - r.distinct_count) <= 0.05 * r.distinct_count
    empty = profile.column_sketches({"t": whole.limit(0)})
    assert empty.collect() == []


def test_median_sketches_keep_their_rank_error(spark):
    rng = np.random.default_rng(1)
    values = {"a": rng.normal(size=20_000), "b": rng.exponential(size=3_000), "c": np.ones(50)}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("d", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    parts = [standardize.median_sketches(p, "g", "v") for p in df.randomSplit([0.5, 0.5], 3)]
    medians = standardize.sketched_medians(evaluate.union_all(parts), "g").collect()
    assert {r.g: r.n for r in medians} == {g: len(v) for g, v in values.items()}
    for r in medians:
        below, upto = (values[r.g] < r.median).mean(), (values[r.g] <= r.median).mean()
        assert below <= 0.5 + 0.0165 * 1.5 and upto >= 0.5 - 0.0165 * 1.5
    products = spark.createDataFrame(
        [(f"SKU{i}", "n", "Tools", None if i % 10 == 0 else str(i), None) for i in range(101)], PRODUCTS)
    filled = standardize.standardize_products(products, sketch_k=400).where("price IS NULL")
    assert {r.price_clean for r in filled.collect()} <= {float(x) for x in range(48, 54)}


def test_fifty_thousand_keywords(spark):
    rng = random.Random(5)
    letters = "abcdefgh"
    keywords = {"": "Rest"} | {
        "".join(rng.choice(letters) for _ in range(rng.randint(3, 9))): f"C{i % 40}" for i in range(50_000)}
    names = ["", "ABC", "é"] + ["".join(rng.choice(letters + " XY") for _ in range(rng.randint(1, 40)))
                               for _ in range(300)]
    ordered = list(keywords.items())[1:] + [("", "Rest")]
    table = standardize.keyword_table(spark, dict(ordered))
    rows = [(f"s{i}", n, None, None, None) for i, n in enumerate(names * 2)]
    rows += [("x", None, None, None, None), ("y", "abc", " own ", None, None)]
    out = standardize.standardize_categories(spark.createDataFrame(rows, PRODUCTS), table)
    got = {(r.product_name, r.category_clean) for r in out.collect()}
    wanted = {n: next(c for k, c in ordered if k in n.lower()) for n in names}
    assert got == {*wanted.items(), (None, None), ("abc", "Own")} and out.count() == len(rows)
    few = dict(ordered[:3000:100])
    df = spark.createDataFrame(rows, PRODUCTS)
    assert sorted(map(str, standardize.standardize_categories(df, few).collect())) == sorted(map(
        str, standardize.standardize_categories(df, standardize.keyword_table(spark, few)).collect()))
    lowered = spark.createDataFrame([(n.lower(),) for n in set(names)], "name string")
    plan = standardize.infer_by_table(lowered, table)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" not in plan and len(plan) < 5_000


def test_a_repeated_run_replaces_its_snapshot(spark, data_dir, store):  # noqa: F811
    phases.load(spark, store, raw.default_paths(data_dir))
    days = [dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1), dt.datetime(2025, 1, 1)]
    for day in days:
        card = phases.run_assess(store, measured_at=day)["quality_scorecard"]
    history = spark.table("governance.quality_scorecard_history")
    assert history.count() == 2 * card.count()
    assert {r.measured_at for r in history.collect()} == set(days)


def test_a_rule_added_as_a_view(spark, data_dir, store):  # noqa: F811
    phases.load(spark, store, raw.default_paths(data_dir))
    before = phases.run_assess(store)["quality_scorecard"].count()
    spark.sql("""CREATE VIEW governance.v_validity_lead_time AS
        SELECT supplier_id AS record_id, 'suppliers' AS table_name, 'validity' AS dimension,
          'short_lead_time' AS rule_name, lead_time_days AS detail
        FROM raw.suppliers WHERE CAST(lead_time_days AS INT) < 5""")
    for _ in range(2):
        out = phases.run_assess(store)
        log = store.read("governance", "violations_log")
        assert [tuple(r) for r in log.where("rule_name = 'short_lead_time'").select(
            "record_id", "detail").collect()] == [("S1", "3")]
        scores = {(r.table_name, r.dimension): r.quality_score for r in out["quality_scorecard"].collect()}
        assert len(scores) == before + 1 and scores["suppliers", "validity"] == 0
    spark.sql("CREATE VIEW governance.v_wrong AS SELECT supplier_id AS record_id FROM raw.suppliers")
    with pytest.raises(ValueError, match="v_wrong has columns"):
        phases.run_assess(store)


def rows_scanned(df):
    """Rows that the scan of a plan without a shuffle gave out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_one_record_is_found_without_reading_its_folder(spark, store):  # noqa: F811
    """Ids without an order: only the Bloom filter can tell which row groups may hold one."""
    ids = F.md5(F.col("id").cast("string"))
    log = spark.range(0, 40_000, 1, 8).select(
        ids.alias("record_id"), F.lit("products").alias("table_name"), F.lit("validity").alias("dimension"),
        F.lit("r").alias("rule_name"), F.lit("d").alias("detail"))
    stored = store.write_log(log)
    wanted = log.first().record_id
    found = report.record_violations(stored, "products", wanted)
    assert rows_scanned(found) < 40_000 and found.count() == 1
    between = wanted[:-1] + ("0" if wanted[-1] != "0" else "1")
    assert rows_scanned(report.record_violations(stored, "products", between)) == 0
    assert rows_scanned(report.record_violations(stored, "suppliers", wanted)) == 0


def test_a_later_session_has_tables_views_and_functions(spark, data_dir, store):  # noqa: F811
    """All databases are dropped, as with a catalog that ends with its session."""
    phases.load(spark, store, raw.default_paths(data_dir), check_keys=True)
    phases.run_assess(store)
    spark.sql("""CREATE VIEW governance.v_accuracy_future AS
        SELECT purchase_order_id AS record_id, 'purchase_orders' AS table_name, 'accuracy' AS dimension,
          'future_order' AS rule_name, order_date AS detail
        FROM raw.purchase_orders WHERE governance.parse_flexible_date(order_date) > DATE '2025-01-01'""")
    before = {r.dimension: r.violation_count for r in phases.run_assess(store)["quality_scorecard"].where(
        "table_name = 'purchase_orders'").collect()}
    phases.run_standardize(store)
    spark.sql("DROP FUNCTION governance.parse_flexible_date")
    for layer in ("raw", "staging", "governance"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")

    phases.prepare(store)
    assert spark.sql("SELECT count(*) FROM governance.v_accuracy_future").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM governance.v_validity_orphan_supplier").first()[0] == 1
    assert spark.table("staging.products").count() == 3
    assert spark.table("governance.staging_rejects").count() == 0
    assert spark.table("governance.violations_log").where("dimension = 'accuracy'").count() == before["accuracy"]
    assert spark.sql("SELECT governance.parse_flexible_date('08/10/2025')").first()[0] == dt.date(2025, 8, 10)
    with pytest.raises(ValueError, match="stored already"):
        phases.load(spark, store, raw.default_paths(data_dir), "append", check_keys=True)
    after = phases.run_assess(store)["quality_scorecard"].where("table_name = 'purchase_orders'")
    assert {r.dimension: r.violation_count for r in after.collect()} == before


def test_a_replacement_that_was_cut_off_is_undone(spark, store, tmp_path):  # noqa: F811
    store.write(spark.range(5).toDF("x"), "raw", "numbers")
    store.write(spark.range(3).toDF("x"), "raw", "others")
    raw_folder = tmp_path / "store/raw"
    (raw_folder / "numbers").rename(raw_folder / "_old-numbers")  # the driver was lost here
    (raw_folder / "_old-others").mkdir()  # or here, before the old folder was deleted
    phases.prepare(store)
    assert store.read("raw", "numbers").count() == 5 and store.read("raw", "others").count() == 3
    assert not list(raw_folder.glob("_old-*"))
    (raw_folder / "numbers").rename(raw_folder / "_old-numbers")
    assert store.write(spark.range(2).toDF("x"), "raw", "numbers").count() == 2
    assert not list(raw_folder.glob("_old-*"))


def test_a_split_is_stored_and_keys_are_counted_in_small_shares(spark, tmp_path, monkeypatch):
    """No task sorts its rows by folder, or counts the keys of a whole split of the input."""
    from pyspark.sql import DataFrameWriter
    from pyspark.sql import functions as F

    from veritable.operators import standardize
    from veritable.sources.tables import Store

    seen, plain, name = [], DataFrameWriter.parquet, "spark.sql.maxConcurrentOutputFileWriters"

    def parquet(self, path, *args, **how):
        seen.append(spark.conf.get(name))
        return plain(self, path, *args, **how)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    before = spark.conf.get(name)
    rows = spark.createDataFrame([("a", "1"), ("b", "x"), (None, "2")], "k string, v string")
    store = Store(spark, str(tmp_path), register=False)
    faults = F.filter(F.array(F.when(F.col("v") == "x", F.struct(F.lit("no number").alias("reason")))),
                      lambda f: f.isNotNull())
    split = store.write_split(rows, "staging", "t", faults, "rejects", max_rejected=None)
    assert seen[0] == "2" and spark.conf.get(name) == before
    assert sorted(map(tuple, split.accepted.collect()), key=repr) == [("a", "1"), (None, "2")]
    assert [r.reason for r in split.rejects.collect()] == ["no number"]

    found = standardize.key_problems(rows.unionByName(rows), ["k"])
    assert sorted(map(tuple, found.collect()), key=repr) == [("a", 2), ("b", 2), (None, 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [_share" in plan
