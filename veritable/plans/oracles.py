"""DuckDB SQL that computes each registered query independently, on the same fixtures.

Scores are rounded on integers, halves away from zero, because DuckDB divides decimals as
doubles.
"""

from __future__ import annotations

from veritable.functions.text import NULL_TOKENS
from veritable.plans.queries import FIRST_RUN, SECOND_RUN
from veritable.sources.fixtures import FIXTURE_KEYWORDS, FIXTURES
from veritable.sources.schemas import ENTITIES

TABLES = tuple(FIXTURES)


# --- fixtures as CTEs -----------------------------------------------------------------


def _raw(name: str) -> str:
    table, sql = FIXTURES[name]
    return sql.replace("{" + table + "}", table).replace("{five}", "unnest([1, 2, 3, 4, 5])")


def _q(column: str) -> str:
    return f'"{column}"'


def _normalized(name: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    columns = ", ".join(
        f"CASE WHEN {_q(c)} IN ({tokens}) THEN NULL ELSE {_q(c)} END AS {_q(c)}"
        for c in ENTITIES[name].columns
    )
    return f"SELECT {columns} FROM ({_raw(name)}) u"


def with_tables(body: str, **more: str) -> str:
    ctes = [f"{n} AS ({_normalized(n)})" for n in TABLES]
    ctes += [f"{n} AS ({sql})" for n, sql in more.items()]
    return f"WITH {', '.join(ctes)}\n{body}"


# --- expressions ----------------------------------------------------------------------


def _capitalized(x: str, word: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '[{word}]+|[^{word}]+'), "
            "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '')")


def initcap(x: str) -> str:
    return _capitalized(f"trim({x}, ' ')", "A-Za-z0-9")


def title(x: str) -> str:
    return _capitalized(f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')", "A-Za-z")


def parsed(x: str, fmt: str) -> str:
    return f"CAST(try_strptime({x}, '{fmt}') AS DATE)"


def flexible(x: str, *formats: str) -> str:
    formats = formats or ("%d-%m-%Y", "%m/%d/%Y", "%Y-%m-%d")
    return f"coalesce({', '.join(parsed(x, f) for f in formats)})"


def half_up(part: str, whole: str, scale: int) -> str:
    """round(part / whole, digits) for scale = 10^digits and whole > 0."""
    return (f"sign({part}) * ((2 * {scale} * abs({part}) + ({whole})) // (2 * ({whole})))"
            f" / {scale}.0")


def num(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


# --- rules ----------------------------------------------------------------------------


def _violations(table: str, key: str, dimension: str, rule: str, detail: str, where: str,
                source: str | None = None) -> str:
    return (f"SELECT {key} AS record_id, '{table}' AS table_name, '{dimension}' AS dimension, "
            f"'{rule}' AS rule_name, {detail} AS detail FROM {source or table} t WHERE {where}")


def _first_null(*columns: str) -> str:
    whens = " ".join(f"WHEN {c} IS NULL THEN '{c}'" for c in columns)
    return f"CASE {whens} END"


def _any_null(*columns: str) -> str:
    return "(" + " OR ".join(f"{c} IS NULL" for c in columns) + ")"


def _sql_rules(products: str) -> dict[str, tuple]:
    """Arguments of ``_violations`` by query name."""
    p, po, tx = "products", "purchase_orders", "inventory_transactions"
    required_p = ("category", "price", "supplier_id")
    required_po = ("qty_ordered", "order_date", "delivery_status")
    prefix = "regexp_extract(sku, '^[A-Za-z]+')"
    return {
        "rule_completeness_products": (
            p, "sku", "completeness", "missing_required_field",
            _first_null(*required_p), _any_null(*required_p), products),
        "rule_completeness_po": (
            po, "purchase_order_id", "completeness", "missing_required_field",
            _first_null(*required_po), _any_null(*required_po)),
        "rule_uniqueness": (
            p, "sku", "uniqueness", "duplicate_product_supplier",
            "'duplicate (product_name, supplier_id) pair'", "n > 1",
            "(SELECT *, count(*) OVER (PARTITION BY product_name, supplier_id) AS n "
            f"FROM {products})"),
        "rule_orphan_supplier": (
            p, "sku", "validity", "orphan_supplier_id",
            "'supplier_id ' || supplier_id || ' not found in suppliers'",
            "supplier_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM suppliers s "
            "WHERE trim(s.supplier_id, ' ') = trim(t.supplier_id, ' '))", products),
        "rule_non_positive_price": (
            p, "sku", "validity", "non_positive_price", "'price = ' || price",
            f"{num('price')} <= 0", products),
        "rule_category": (
            p, "sku", "consistency", "non_canonical_category",
            "'category = \"' || category || '\"'", f"category <> {initcap('category')}", products),
        "rule_delivery_status": (
            po, "purchase_order_id", "consistency", "non_canonical_delivery_status",
            "'delivery_status = \"' || delivery_status || '\"'",
            f"delivery_status <> {initcap('delivery_status')}"),
        "rule_transaction_type": (
            tx, "transaction_id", "consistency", "non_canonical_transaction_type",
            "'transaction_type = \"' || transaction_type || '\"'",
            "transaction_type <> upper(trim(transaction_type, ' '))"),
        "rule_sku_prefix": (
            p, "sku", "consistency", "non_standard_sku_prefix", f"'prefix = ' || {prefix}",
            f"{prefix} NOT IN ('', 'SKU')", products),
        "rule_date_format": (
            po, "purchase_order_id", "consistency", "non_primary_date_format",
            "'order_date = \"' || order_date || '\" did not match DD-MM-YYYY'",
            "NOT regexp_full_match(order_date, '[0-9]{2}-[0-9]{2}-[0-9]{4}') "
            f"AND {flexible('order_date')} IS NOT NULL"),
        "rule_po_dates": (
            po, "purchase_order_id", "accuracy", "delivery_before_order",
            "'expected_delivery_date before order_date'",
            f"{flexible('expected_delivery_date')} < {flexible('order_date')}"),
        "rule_sign": (
            tx, "transaction_id", "accuracy", "sign_mismatch",
            "transaction_type || ' with quantity_change = ' || quantity_change",
            "CASE upper(trim(transaction_type, ' ')) "
            f"WHEN 'OUTBOUND' THEN {num('quantity_change')} > 0 "
            f"WHEN 'INBOUND' THEN {num('quantity_change')} < 0 END"),
    }


def sql_rule_texts(products: str = "products") -> dict[str, str]:
    """Rule texts by query name. ``products`` may name another frame of the same columns."""
    return {name: _violations(*args) for name, args in _sql_rules(products).items()}


def _some_rule(name: str, source: str) -> str:
    """A rule over another frame of the same columns."""
    return _violations(*_sql_rules("products")[name][:6], source)


def _union(texts) -> str:
    return " UNION ALL ".join(f"({t})" for t in texts)


LOG = _union(sql_rule_texts().values())


def _cell(table: str, key: str, dimension: str, rule: str, where: str,
          source: str | None = None) -> str:
    return (f"SELECT '{table}' AS table_name, '{dimension}' AS dimension, "
            f"'{rule}' AS rule_name, {key} AS record_id FROM {source or table} t WHERE {where}")


def _off_format(column: str, fmt: str) -> str:
    return f"{column} IS NOT NULL AND try_strptime({column}, '{fmt}') IS NULL"


def cell_rule_texts() -> dict[str, str]:
    p, po, tx = "products", "purchase_orders", "inventory_transactions"
    key = {p: "sku", po: "purchase_order_id", tx: "transaction_id", "inventory": "sku"}
    missing = [
        _cell(t, key[t], "completeness", f"missing_{c}", f"{c} IS NULL")
        for t, columns in ((p, ("category", "price", "supplier_id")),
                           (po, ("qty_ordered", "order_date", "delivery_status")))
        for c in columns
    ]
    later = ("(SELECT *, row_number() OVER (PARTITION BY product_name, supplier_id "
             "ORDER BY regexp_replace(sku, '^[A-Za-z]+', ''), sku) AS position FROM products)")
    dirty_case = [
        _cell(p, "sku", "consistency", "non_canonical_category",
              f"category <> {title('category')}"),
        _cell(po, "purchase_order_id", "consistency", "non_canonical_delivery_status",
              f"delivery_status <> {title('delivery_status')}"),
        _cell(tx, "transaction_id", "consistency", "non_canonical_transaction_type",
              "transaction_type <> upper(trim(transaction_type))"),
    ]
    off = [
        _cell(t, key[t], "accuracy", f"off_format_{c}", _off_format(c, fmt))
        for t, c, fmt in ((po, "order_date", "%d-%m-%Y"),
                          (po, "expected_delivery_date", "%d-%m-%Y"),
                          ("inventory", "last_updated", "%Y-%m-%d"))
    ]
    return {
        "cell_completeness": _union(missing),
        "surplus_duplicates": _cell(p, "sku", "uniqueness", "surplus_product_supplier",
                                    "position > 1", later),
        "orphan_untrimmed": _cell(
            p, "sku", "validity", "orphan_supplier_id",
            "supplier_id IS NOT NULL AND supplier_id NOT IN (SELECT supplier_id FROM suppliers)"),
        "title_case_rules": _union(dirty_case),
        "date_accuracy": _union(off),
    }


CELL_LOG = _union(cell_rule_texts().values())


# --- scores ---------------------------------------------------------------------------

ROWS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)

CELLS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, "
    + " + ".join(f"count({_q(c)})" for c in ENTITIES[t].columns) + f" AS cells FROM {t}"
    for t in TABLES)
BARE_KEY = "regexp_replace(sku, '^(ITM|PROD)', '')"


def card(log: str) -> str:
    """Scorecard with the score also as an integer, ``k`` ten-thousandths."""
    counted = (f"SELECT table_name, dimension, count(*) AS violation_count FROM ({log}) l "
               "GROUP BY table_name, dimension")
    return ("SELECT c.table_name, c.dimension, c.violation_count, r.row_count, "
            f"{half_up('(r.row_count - c.violation_count)', 'r.row_count', 10000)} "
            "AS quality_score FROM "
            f"({counted}) c JOIN ({ROWS}) r ON c.table_name = r.table_name")


def ten_thousandths(score: str) -> str:
    return f"CAST(round({score} * 10000) AS BIGINT)"


CARD = card(LOG)
DOMAINS = f"""
SELECT table_name AS domain, {half_up('sum(k)', 'count(*) * 10000', 10000)} AS overall_score,
  CAST(sum(violation_count) AS BIGINT) AS total_violations
FROM (SELECT *, {ten_thousandths('quality_score')} AS k FROM card) c GROUP BY table_name"""
CELL_CARD = f"""
SELECT c.table_name, dimension, violation_count, row_count,
  round_even((1.0::DOUBLE - violation_count::DOUBLE / row_count) * 10000, 0) / 10000
    AS quality_score
FROM (SELECT table_name, dimension, count(*) AS violation_count
      FROM ({CELL_LOG}) l GROUP BY table_name, dimension) c
JOIN ({ROWS}) r ON c.table_name = r.table_name"""
DIMENSIONS = """
SELECT dimension, CAST(sum(violation_count) AS BIGINT) AS violation_count
FROM card GROUP BY dimension"""


# --- profiling ------------------------------------------------------------------------

DIRTY_WS = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"

COLUMN_PROFILE = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS row_count,
  count(*) - count({_q(c)}) AS null_count,
  round_even(100.0::DOUBLE * (count(*) - count({_q(c)})) / count(*) * 100, 0) / 100 AS null_pct,
  count(DISTINCT {_q(c)}) AS distinct_count,
  count(*) FILTER ({_q(c)} <> {DIRTY_WS.format(c=_q(c))}) AS whitespace_dirty_count FROM {t}"""
    for t in TABLES for c in ENTITIES[t].columns
)

DUPLICATE_CHECKS = " UNION ALL ".join(
    f"""SELECT '{label} duplicated' AS "check", CAST(coalesce(sum(n - 1), 0) AS BIGINT)
  AS violation_count FROM (SELECT count(*) AS n FROM {t} GROUP BY {keys}) g"""
    for label, t, keys in (
        ("products.sku", "products", "sku"),
        ("products.(product_name, supplier_id)", "products", "product_name, supplier_id"),
        ("suppliers.supplier_id", "suppliers", "supplier_id"),
    )
)

FK_CHECKS = " UNION ALL ".join(
    f"""SELECT '{child}.{c} not in {parent}' AS "check", count(*) AS violation_count
  FROM {child} t WHERE {"t." + c + " IS NOT NULL AND" if skip else ""} NOT EXISTS
  (SELECT 1 FROM {parent} p WHERE p.{c} IS NOT DISTINCT FROM t.{c})"""
    for child, c, parent, skip in (
        ("products", "supplier_id", "suppliers", True),
        ("inventory", "sku", "products", False),
        ("inventory_transactions", "sku", "products", False),
        ("purchase_orders", "sku", "products", False),
        ("purchase_orders", "supplier_id", "suppliers", False),
    )
)

DATE_COLUMNS = (
    ("purchase_orders", "order_date", "%d-%m-%Y"),
    ("purchase_orders", "expected_delivery_date", "%d-%m-%Y"),
    ("inventory", "last_updated", "%Y-%m-%d"),
    ("inventory_transactions", "timestamp", "%Y-%m-%dT%H:%M:%S"),
)
DATE_VIOLATIONS = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", '{f}' AS expected_format,
  {_q(c)} AS raw_value FROM {t} WHERE {_off_format(_q(c), f)}""" for t, c, f in DATE_COLUMNS)
DATE_VIOLATION_COUNTS = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column",
  count(*) FILTER ({_off_format(_q(c), f)}) AS violation_count FROM {t}"""
    for t, c, f in DATE_COLUMNS)


# --- standardization ------------------------------------------------------------------

_KEYWORDS = " ".join(
    f"WHEN contains(lower(product_name), '{k}') THEN '{c}'" for k, c in FIXTURE_KEYWORDS.items())
TAGGED = (f"SELECT *, coalesce({title('category')}, CASE {_KEYWORDS} END) AS category_clean, "
          "'SKU' || regexp_replace(sku, '^[A-Za-z]+', '') AS sku_clean FROM products")
MEDIANS = """
SELECT category_clean,
  (max(p) FILTER (i = (n + 1) // 2) + max(p) FILTER (i = n // 2 + 1)) / 2 AS median
FROM (SELECT category_clean, p, count(*) OVER (PARTITION BY category_clean) AS n,
        row_number() OVER (PARTITION BY category_clean ORDER BY p) AS i
      FROM (SELECT category_clean, TRY_CAST(price AS DOUBLE) AS p FROM tagged) x
      WHERE p IS NOT NULL AND category_clean IS NOT NULL) y
GROUP BY category_clean"""
AUDIT = """
SELECT t.sku, t.product_name, t.category, TRY_CAST(t.price AS DOUBLE) AS price, t.supplier_id,
  t.category_clean, t.sku_clean, coalesce(TRY_CAST(t.price AS DOUBLE), m.median) AS price_clean
FROM tagged t LEFT JOIN medians m ON t.category_clean = m.category_clean"""
FINAL = """
SELECT sku_clean AS sku, product_name, category_clean AS category, price_clean AS price,
  supplier_id FROM audit"""
PRODUCT_STEPS = {"tagged": TAGGED, "medians": MEDIANS, "audit": AUDIT, "final": FINAL}

RECOVERY = {
    "purchase_orders": {"order_date": ("%d-%m-%Y", "%m/%d/%Y", "%Y-%m-%d"),
                        "expected_delivery_date": ("%d-%m-%Y", "%m/%d/%Y", "%Y-%m-%d")},
    "inventory": {"last_updated": ("%Y-%m-%d", "%d-%m-%Y", "%m/%d/%Y")},
}


def _standardized(table: str) -> str:
    added = ", ".join(
        f"{flexible(c, *f)} AS {c}_standardized" for c, f in RECOVERY[table].items())
    return f"SELECT *, {added} FROM {table}"


RECOVERY_COUNTS = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", count({c}) AS non_null,
  count({parsed(c, f[0])}) AS primary_ok,
  count({flexible(c, *f)}) - count({parsed(c, f[0])}) AS recovered,
  count({c}) - count({flexible(c, *f)}) AS unresolved FROM {t}"""
    for t, columns in RECOVERY.items() for c, f in columns.items())


def _issue(name: str, table: str, affected: str, resolved: str) -> str:
    return (f"SELECT '{name}' AS issue, count(*) FILTER ({affected}) AS affected, "
            f"count(*) FILTER (({affected}) AND ({resolved})) AS resolved, "
            f"count(*) FILTER ({affected}) - count(*) FILTER (({affected}) AND ({resolved})) "
            f"AS unresolved FROM {table}")


REMEDIATION = " UNION ALL ".join([
    _issue("non-canonical category", "audit", f"category <> {title('category')}",
           f"category_clean = {title('category_clean')}"),
    _issue("null category", "audit", "category IS NULL", "category_clean IS NOT NULL"),
    _issue("non-standard sku prefix", "audit", "sku <> sku_clean", "sku_clean IS NOT NULL"),
    _issue("null price", "audit", "price IS NULL", "price_clean IS NOT NULL"),
    *[_issue(f"malformed {c}", t, _off_format(c, f[0]), f"{flexible(c, *f)} IS NOT NULL")
      for t, columns in RECOVERY.items() for c, f in columns.items()],
])

REVIEW = _union([
    *[f"SELECT record_id, rule_name AS reason, detail FROM ({sql_rule_texts()[r]}) r"
      for r in ("rule_uniqueness", "rule_orphan_supplier")],
    "SELECT sku AS record_id, 'category_not_inferable' AS reason, "
    "'product_name = \"' || product_name || '\"' AS detail FROM tagged "
    "WHERE category_clean IS NULL",
])

# Scores before and after the products are standardized.
AFTER = card(_union(sql_rule_texts("final2").values()))
HISTORY = f"""
SELECT '{FIRST_RUN:%Y-%m-%d}' AS measured_at, * FROM card
UNION ALL SELECT '{SECOND_RUN:%Y-%m-%d}' AS measured_at, * FROM after"""
HISTORY_STEPS = {
    **PRODUCT_STEPS,
    "final2": "SELECT * REPLACE (CAST(price AS VARCHAR) AS price) FROM final",
    "card": CARD, "after": AFTER, "history": HISTORY,
}


def _lost(table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{c}' AS "column",
  count({c}) - count(TRY_CAST({c} AS {"DATE" if t == "date" else "DOUBLE"})) AS lost FROM {table}"""
        for c, t in ENTITIES[table].typed.items())


def _collisions(table: str) -> str:
    return (f"SELECT '{table}' AS table_name, sku_clean, count(*) AS n FROM "
            "(SELECT 'SKU' || regexp_replace(sku, '^[A-Za-z]+', '') AS sku_clean "
            f"FROM {table}) x GROUP BY sku_clean HAVING count(*) > 1")


def _staged(table: str) -> str:
    columns = []
    for c in ENTITIES[table].columns:
        kind = ENTITIES[table].typed.get(c)
        if kind == "date":
            columns.append(f"{flexible(c, *RECOVERY[table][c])} AS {c}")
        elif kind:
            columns.append(f"TRY_CAST({c} AS DOUBLE) AS {c}")
        else:
            columns.append(c)
    return f"SELECT {', '.join(columns)} FROM {table}"


_TAIL = "right(sku, 2)"
_LINE = ("sku || ',' || CASE WHEN {tail} IN ('57', '91') THEN '\"' ELSE '' END || product_name || ',' || "
         "coalesce(category, '') || ',' || coalesce(price, '') || ',' || coalesce(supplier_id, '') || "
         "CASE WHEN {tail} IN ('13', '91') THEN ',EXTRA' ELSE '' END").format(tail=_TAIL)
RAW_REJECTS = f"""
SELECT NULL AS line, 'loaded' AS reason, count(*) AS n FROM ({_raw('products')}) p
WHERE {_TAIL} NOT IN ('13', '57', '91')
UNION ALL SELECT {_LINE}, CASE {_TAIL} WHEN '13' THEN 'too many cells' ELSE 'unclosed quote' END, 1
FROM ({_raw('products')}) p WHERE {_TAIL} IN ('13', '57', '91')"""

_FAULTY = """
SELECT *, coalesce(sku, '') || '|' || coalesce(warehouse_id, '') AS key,
  count(*) OVER (PARTITION BY sku, warehouse_id) > 1 AS repeated,
  last_updated IS NOT NULL AND TRY_CAST(last_updated AS DATE) IS NULL AS undated FROM inventory"""
STAGING_REJECTS = """
SELECT NULL AS key, NULL AS "column", NULL AS raw_value, 'staged' AS reason, count(*) AS n
FROM faulty WHERE NOT repeated AND NOT undated
UNION ALL SELECT key, 'sku', sku, 'key is repeated', 1 FROM faulty WHERE repeated
UNION ALL SELECT key, 'last_updated', last_updated, 'no date', 1 FROM faulty WHERE undated"""

BY_KEYWORD = f"""
WITH pieces AS (SELECT lower(substr(p_name, CAST(1 + p_partkey % 4 AS INT),
    CAST(3 + p_partkey % 5 AS INT))) AS keyword, p_partkey, p_brand FROM part),
keywords AS (SELECT keyword, min(p_partkey) AS priority, arg_min(p_brand, p_partkey) AS category
  FROM pieces GROUP BY keyword),
named AS (SELECT name, arg_min(category, priority) AS category
  FROM (SELECT DISTINCT lower(product_name) AS name FROM products WHERE category IS NULL) n
  JOIN keywords ON contains(name, keyword) GROUP BY name)
SELECT sku, product_name, coalesce({title('p.category')}, n.category) AS category_clean
FROM products p LEFT JOIN named n ON p.category IS NULL AND lower(p.product_name) = n.name"""


_USER_RULE = ("SELECT sku AS record_id, 'products' AS table_name, 'validity' AS dimension, "
              "'short_name' AS rule_name, product_name AS detail FROM products "
              "WHERE length(product_name) < 10")
RECORD_LOOKUP = """
SELECT l.* FROM log l JOIN (SELECT table_name, max(record_id) AS record_id FROM log
  GROUP BY table_name) m ON l.table_name = m.table_name AND l.record_id = m.record_id"""


def oracle_sql() -> dict[str, str]:
    grouped = "SELECT dimension, count(*) AS n FROM ({log}) l GROUP BY dimension"
    share = half_up("(100 * violation_count)", "total", 100)
    total = "(SELECT sum(violation_count) FROM card)"
    percent = f"SELECT dimension, violation_count, {share} AS {{name}} FROM " \
              f"(SELECT *, {{total}} AS total FROM ({DIMENSIONS}) d) s"
    pivot = ", ".join(
        f"max(quality_score) FILTER (dimension = '{d}') AS {d}"
        for d in ("completeness", "uniqueness", "validity", "consistency", "accuracy"))
    broken = ("SELECT record_id, string_agg(DISTINCT rule_name, ', ' ORDER BY rule_name) AS rules "
              "FROM log WHERE table_name = 'purchase_orders' AND dimension = 'consistency' "
              "GROUP BY record_id")
    domain_score = "(SELECT max(overall_score) FROM domains WHERE domain = '{}')"
    by_rule = ("SELECT table_name, dimension, rule_name, count(*) AS n, "
               "count(DISTINCT record_id) AS records FROM ({log}) l "
               "GROUP BY table_name, dimension, rule_name")
    counts = ("SELECT table_name, dimension, rule_name, count(*) AS violation_count "
              "FROM log GROUP BY table_name, dimension, rule_name")
    catalog = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{dimension}' AS dimension, '{rule}' AS rule_name"
        for table, _, dimension, rule, *_ in _sql_rules("products").values())

    out = {
        "load_normalized_products": with_tables("SELECT * FROM products"),
        "csv_roundtrip": with_tables("SELECT * FROM products"),
        "raw_load_counts": with_tables(ROWS),
        "raw_append": with_tables(
            f"SELECT table_name, 2 * row_count AS row_count FROM ({ROWS}) r"),
        "raw_reset": with_tables(ROWS),
        "registry_scan": with_tables(CELLS),
        "record_lookup": with_tables(RECORD_LOOKUP, log=LOG),
        "catalog_rules": with_tables(card(_union([LOG, _USER_RULE]))),
        "appended_keys": with_tables(
            "SELECT purchase_order_id FROM purchase_orders WHERE right(purchase_order_id, 1) = '9'"),
        "surplus_in_file_order": with_tables(_cell(
            "products", "sku", "uniqueness", "surplus_product_supplier", "position > 1",
            "(SELECT *, row_number() OVER (PARTITION BY product_name, supplier_id "
            "ORDER BY md5(sku)) AS position FROM products)")),
        "raw_rejects": with_tables(RAW_REJECTS),
        "staging_rejects": with_tables(STAGING_REJECTS, faulty=_FAULTY),
        "category_by_keyword_table": with_tables(f"SELECT * FROM ({BY_KEYWORD}) k"),
        "category_medians_sketched": with_tables(
            "SELECT category_clean, count(*) AS n, true AS close FROM tagged "
            "WHERE category_clean IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NOT NULL "
            "GROUP BY category_clean", tagged=TAGGED),
        "profile_merged": with_tables(
            f"SELECT * EXCLUDE (distinct_count), true AS distinct_close FROM ({COLUMN_PROFILE}) c"),
        "history_rerun": with_tables("SELECT * FROM history", **HISTORY_STEPS),
        "layers": with_tables(_union(
            f"SELECT '{layer}' AS layer, count(*) AS row_count, "
            f"count(DISTINCT category) AS categories FROM products WHERE {where}"
            for layer, where in (("raw", "true"), ("staging", "category IS NOT NULL")))),
        "rule_sku_without_letters": with_tables(_some_rule(
            "rule_sku_prefix",
            f"(SELECT * REPLACE ({BARE_KEY} AS sku) FROM products)")),
        "rule_sign_with_zero": with_tables(_some_rule(
            "rule_sign",
            "(SELECT * REPLACE (CASE WHEN right(quantity_change, 1) = '7' THEN '0' "
            "ELSE quantity_change END AS quantity_change) FROM inventory_transactions)")),
        "casing": with_tables(
            f"SELECT sku, trim(v, ' ') AS trimmed, trim(v, e' \\t') AS stripped, "
            f"{initcap('v')} AS initcap, {title('v')} AS title, "
            f"category <> {initcap('category')} AS not_initcap, "
            f"category <> {title('category')} AS not_title FROM (SELECT sku, category, "
            "e' \\t' || lower(product_name) || '3d-x o''B ' || category || e'\\t ' AS v "
            "FROM products) p"),
        "key_prefixes": with_tables(
            "SELECT key, nullif(regexp_extract(key, '^[A-Za-z]+'), '') AS prefix, "
            "regexp_replace(key, '^[A-Za-z]+', '') AS rest, "
            "'SKU' || regexp_replace(key, '^[A-Za-z]+', '') AS rewritten "
            f"FROM (SELECT {BARE_KEY} AS key FROM products) p"),
        "table_row_counts": with_tables(ROWS),
        **{name: with_tables(text) for name, text in sql_rule_texts().items()},
        "rule_views": with_tables(grouped.format(log=LOG)),
        "flexible_dates": with_tables(
            f"SELECT purchase_order_id, {flexible('order_date')} AS order_date, "
            f"{flexible('expected_delivery_date')} AS expected_delivery_date "
            "FROM purchase_orders"),
        "violations_log": with_tables(LOG),
        "violation_counts": with_tables(
            f"SELECT k.*, coalesce(c.violation_count, 0) AS violation_count, r.row_count "
            f"FROM ({catalog}) k LEFT JOIN ({counts}) c USING (table_name, dimension, rule_name) "
            f"JOIN ({ROWS}) r ON r.table_name = k.table_name", log=LOG),
        "scorecard": with_tables(CARD),
        "scorecard_from_log": with_tables(CARD),
        "scorecard_worst_first": with_tables(CARD),
        "scorecard_domain": with_tables(DOMAINS, card=CARD),
        **{name: with_tables(text) for name, text in cell_rule_texts().items()},
        "cell_log": with_tables(
            f"SELECT table_name, dimension, record_id FROM ({CELL_LOG}) l"),
        "cell_scorecard": with_tables(CELL_CARD),
        "cell_domain": with_tables(
            "SELECT table_name, list_reduce(list(quality_score ORDER BY dimension), "
            "lambda a, b: a + b) / count(*) AS overall_score, "
            "CAST(sum(violation_count) AS BIGINT) AS total_violations "
            f"FROM ({CELL_CARD}) c GROUP BY table_name"),
        "column_profile": with_tables(COLUMN_PROFILE),
        "null_offenders": with_tables(
            f"SELECT * FROM ({COLUMN_PROFILE}) c WHERE null_count > 0"),
        "duplicate_checks": with_tables(DUPLICATE_CHECKS),
        "fk_checks": with_tables(FK_CHECKS),
        "prefix_distribution": with_tables(
            "SELECT regexp_extract(sku, '^[A-Za-z]+') AS prefix, count(*) AS n "
            "FROM products GROUP BY 1"),
        "date_violations": with_tables(DATE_VIOLATIONS),
        "date_violation_counts": with_tables(DATE_VIOLATION_COUNTS),
        "category_clean": with_tables(
            "SELECT sku, category, category_clean FROM tagged", tagged=TAGGED),
        "category_inferred": with_tables(
            "SELECT sku, product_name, category_clean FROM tagged WHERE category IS NULL",
            tagged=TAGGED),
        "category_medians": with_tables(MEDIANS, tagged=TAGGED),
        "sku_clean": with_tables("SELECT sku, sku_clean FROM tagged", tagged=TAGGED),
        "sku_collisions": with_tables(_union([_collisions("products"), _collisions("inventory")])),
        "price_imputed": with_tables(
            "SELECT sku, category_clean, price, price_clean FROM audit", **PRODUCT_STEPS),
        "po_dates_standardized": with_tables(_standardized("purchase_orders")),
        "inventory_dates_standardized": with_tables(_standardized("inventory")),
        "date_recovery_counts": with_tables(RECOVERY_COUNTS),
        "staging_products_audit": with_tables("SELECT * FROM audit", **PRODUCT_STEPS),
        "staging_products_final": with_tables("SELECT * FROM final", **PRODUCT_STEPS),
        "staging_typed_products": with_tables(
            "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM final",
            **PRODUCT_STEPS),
        "staging_key_check": with_tables(
            "SELECT 'purchase_orders' AS table_name, purchase_order_id AS key, count(*) AS n "
            "FROM purchase_orders GROUP BY purchase_order_id "
            "HAVING count(*) > 1 OR purchase_order_id IS NULL "
            "UNION ALL SELECT 'products', product_name || '|' || coalesce(supplier_id, '-'), "
            "count(*) FROM products GROUP BY product_name, supplier_id "
            "HAVING count(*) > 1 OR product_name IS NULL OR supplier_id IS NULL"),
        "staging_wide_numbers": with_tables(
            "SELECT sku, '123456789' || lpad(CAST(length(sku) AS VARCHAR), 6, '4') || '.12345' "
            "|| '00000' AS price FROM products"),
        "staging_lost_casts": with_tables(f"{_lost('products')} UNION ALL {_lost('inventory')}"),
        "staging_typed_po": with_tables(_staged("purchase_orders")),
        "staging_typed_inventory": with_tables(_staged("inventory")),
        "dimension_counts": with_tables(DIMENSIONS, card=CARD),
        "top_category": with_tables(
            f"SELECT * FROM ({DIMENSIONS}) d ORDER BY violation_count DESC, dimension LIMIT 1",
            card=CARD),
        "composition": with_tables(
            percent.format(name="pct_of_violations", total=total), card=CARD),
        "prevalence": with_tables(
            f"SELECT dimension, violation_count, CAST(total AS BIGINT) AS total_rows, "
            f"{share} AS prevalence_pct FROM (SELECT *, (SELECT sum(row_count) FROM ({ROWS}) r) "
            f"AS total FROM ({DIMENSIONS}) d) s", card=CARD),
        "heatmap": with_tables(
            f"SELECT table_name, {pivot} FROM card GROUP BY table_name", card=CARD),
        "drillthrough": with_tables(
            f"SELECT p.*, b.rules FROM purchase_orders p JOIN ({broken}) b "
            "ON p.purchase_order_id = b.record_id", log=LOG),
        "remediation_summary": with_tables(REMEDIATION, **PRODUCT_STEPS),
        "review_queue": with_tables(REVIEW, tagged=TAGGED),
        "headline": with_tables(
            f"SELECT CAST({total} AS BIGINT) AS total_violations, count(*) AS tables_assessed, "
            "CAST(sum(row_count) AS BIGINT) AS total_rows, "
            "(SELECT count(DISTINCT dimension) FROM card) AS dimensions, "
            "(SELECT CAST(sum(resolved) AS BIGINT) FROM remediation "
            " WHERE issue = 'non-standard sku prefix') AS skus_standardized, "
            "(SELECT CAST(sum(affected) AS BIGINT) FROM remediation "
            " WHERE issue LIKE 'malformed%') AS malformed_dates, "
            "(SELECT CAST(sum(resolved) AS BIGINT) FROM remediation "
            " WHERE issue LIKE 'malformed%') AS dates_recovered, "
            + ", ".join(f"{domain_score.format(t)} AS {t}_score" for t in (
                "products", "purchase_orders", "inventory_transactions"))
            + ", (SELECT arg_max(dimension, violation_count) FROM comp) AS largest_dimension, "
            "(SELECT max(pct) FROM comp) AS largest_dimension_pct "
            f"FROM ({ROWS}) r",
            **PRODUCT_STEPS, card=CARD, domains=DOMAINS, remediation=REMEDIATION,
            comp=percent.format(name="pct", total=total)),
        "sink_roundtrip": with_tables(by_rule.format(log=LOG)),
        "history_append": with_tables(
            "SELECT * EXCLUDE (measured_at) FROM history", **HISTORY_STEPS),
        "score_trend": with_tables(
            "SELECT measured_at, table_name, dimension, quality_score, previous_score, "
            f"({ten_thousandths('quality_score')} - {ten_thousandths('previous_score')}) "
            "/ 10000.0 AS change FROM (SELECT *, lag(quality_score) OVER "
            "(PARTITION BY table_name, dimension ORDER BY measured_at) AS previous_score "
            "FROM history) h", **HISTORY_STEPS),
    }
    return out
