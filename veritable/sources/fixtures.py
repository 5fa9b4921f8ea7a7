"""Dirty ERP tables derived from the TPC-H-like tables, for tests, checks and the benchmark.

Every fixture is one SQL text that Spark and DuckDB both run; ``{part}`` and the like stand
for the source table, ``{five}`` for the dialect's way to make five rows of one.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from veritable.sources.raw import normalize_nulls

_PREFIX = "CASE {k} % 4 WHEN 0 THEN 'ITM' WHEN 1 THEN 'SKU' WHEN 2 THEN 'PRO' ELSE 'PROD' END"


def _pad(expr: str, width: int) -> str:
    return f"lpad(CAST({expr} AS STRING), {width}, '0')"


def _sku(k: str) -> str:
    return f"({_PREFIX.format(k=k)} || {_pad(k, 9)})"


def _supplier(k: str) -> str:
    return f"'SUP' || {_pad(k, 5)}"


def _dmy(day: str, month: str, year: str) -> str:
    return f"{_pad(day, 2)} || '-' || {_pad(month, 2)} || '-' || CAST({year} AS STRING)"


def _mdy(day: str, month: str, year: str) -> str:
    return f"{_pad(month, 2)} || '/' || {_pad(day, 2)} || '/' || CAST({year} AS STRING)"


def _ymd(day: str, month: str, year: str) -> str:
    return f"CAST({year} AS STRING) || '-' || {_pad(month, 2)} || '-' || {_pad(day, 2)}"


_TYPE = "(upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)))"

DIRTY_PRODUCTS = f"""
SELECT {_sku('p_partkey')} AS sku,
  p_name || ' ' || CAST(p_size % 3 AS STRING) AS product_name,
  CASE WHEN p_partkey % 97 = 5 THEN NULL
       WHEN p_partkey % 20 = 3 THEN ' ' || {_TYPE} || ' '
       WHEN p_partkey % 20 = 7 THEN {_TYPE} || ' '
       WHEN p_partkey % 41 = 0 THEN p_type
       ELSE {_TYPE} END AS category,
  CASE WHEN p_partkey % 25 = 4 THEN NULL
       WHEN p_partkey % 211 = 0 THEN '-1.00'
       WHEN p_partkey % 223 = 1 THEN '0.00'
       WHEN p_partkey % 307 = 2 THEN 'N/A'
       ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) END AS price,
  CASE WHEN p_partkey % 18 = 5 THEN NULL
       WHEN p_partkey % 67 = 0 THEN 'SUP99999'
       WHEN p_partkey % 29 = 0 THEN ' ' || {_supplier('p_partkey % 10')}
       ELSE {_supplier('p_partkey % 10')} END AS supplier_id
FROM {{part}}"""

DIRTY_SUPPLIERS = f"""
SELECT {_supplier('s_suppkey')} AS supplier_id, s_name AS name,
  CAST(s_suppkey % 35 + 1 AS STRING) AS lead_time_days,
  CAST(CAST(70 + s_suppkey % 30 AS DECIMAL(5,1)) AS STRING) AS reliability_score
FROM {{supplier}}"""

_INV_DAY, _INV_MONTH = "(p_partkey * 3 + w) % 28 + 1", "p_partkey % 12 + 1"

DIRTY_INVENTORY = f"""
SELECT CASE WHEN p_partkey % 101 = 0 AND w = 5 THEN 'SKU-MISSING'
            ELSE {_sku('p_partkey')} END AS sku,
  'WH' || CAST(w AS STRING) AS warehouse_id,
  CASE WHEN (p_partkey + w) % 59 = 0 THEN NULL
       ELSE CAST((p_partkey * 7 + w * 13) % 640 AS STRING) END AS current_stock,
  CAST(p_partkey % 101 AS STRING) AS safety_stock,
  CASE WHEN (p_partkey + w) % 50 = 0 THEN {_dmy(_INV_DAY, _INV_MONTH, '2025')}
       WHEN (p_partkey + w) % 71 = 1 THEN {_mdy(_INV_DAY, _INV_MONTH, '2025')}
       WHEN (p_partkey + w) % 997 = 2 THEN 'unknown'
       ELSE {_ymd(_INV_DAY, _INV_MONTH, '2025')} END AS last_updated
FROM (SELECT p_partkey, {{five}} AS w FROM {{part}}) t"""

_KIND = "(CASE WHEN event_id % 2 = 0 THEN 'INBOUND' ELSE 'OUTBOUND' END)"
_CLOCK = " || ':' || ".join(
    [_pad("hour(ts)", 2), _pad("minute(ts)", 2), _pad("CAST(floor(second(ts)) AS INT)", 2)]
)
_DAY = _ymd("day(ts)", "month(ts)", "year(ts)")

DIRTY_INVENTORY_TRANSACTIONS = f"""
SELECT 'TXN' || {_pad('event_id', 9)} AS transaction_id,
  {_sku('(event_id % 200)')} AS sku,
  'WH' || CAST(event_id % 5 + 1 AS STRING) AS warehouse_id,
  CASE WHEN event_id % 31 = 0 THEN NULL
       WHEN event_id % 33 = 1 THEN lower({_KIND})
       WHEN event_id % 37 = 2 THEN ' ' || {_KIND}
       ELSE {_KIND} END AS transaction_type,
  CAST(CASE WHEN (event_id % 2 = 0) = (event_id % 503 <> 7) THEN event_id % 400 + 1
            ELSE -(event_id % 400 + 1) END AS STRING) AS quantity_change,
  CASE WHEN event_id % 53 = 0 THEN NULL
       WHEN event_id % 71 = 1 THEN {_DAY} || ' ' || {_CLOCK}
       ELSE {_DAY} || 'T' || {_CLOCK} END AS timestamp
FROM {{events}}"""

_O_DAY, _O_MONTH = "least(day(o_orderdate), 28)", "month(o_orderdate)"

DIRTY_PURCHASE_ORDERS = f"""
SELECT 'PO' || {_pad('o_orderkey', 9)} AS purchase_order_id,
  {_supplier('o_custkey % 10')} AS supplier_id,
  {_sku('(o_orderkey % 200)')} AS sku,
  CASE WHEN o_orderkey % 51 = 0 THEN NULL
       ELSE CAST(o_orderkey % 499 + 1 AS STRING) END AS qty_ordered,
  CASE WHEN o_orderkey % 48 = 1 THEN NULL
       WHEN o_orderkey % 125 = 2 THEN {_mdy(_O_DAY, _O_MONTH, 'year(o_orderdate)')}
       ELSE {_dmy(_O_DAY, _O_MONTH, 'year(o_orderdate)')} END AS order_date,
  CASE WHEN o_orderkey % 509 = 5 THEN '31-02-2020'
       WHEN o_orderkey % 143 = 3 THEN {_dmy(_O_DAY, _O_MONTH, '(year(o_orderdate) - 1)')}
       WHEN o_orderkey % 83 = 4 THEN {_mdy(_O_DAY, _O_MONTH, '(year(o_orderdate) + 1)')}
       ELSE {_dmy(_O_DAY, _O_MONTH, '(year(o_orderdate) + 1)')} END AS expected_delivery_date,
  CASE WHEN o_orderkey % 42 = 0 THEN NULL
       WHEN o_orderkey % 36 = 1 THEN lower(s)
       WHEN o_orderkey % 40 = 2 THEN ' ' || s || ' '
       ELSE s END AS delivery_status
FROM (SELECT o_orderkey, o_custkey, o_orderdate,
        CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending'
             ELSE 'In-Transit' END AS s
      FROM {{orders}}) t"""

# fixture -> (source table, SQL text)
FIXTURES: dict[str, tuple[str, str]] = {
    "products": ("part", DIRTY_PRODUCTS),
    "suppliers": ("supplier", DIRTY_SUPPLIERS),
    "inventory": ("part", DIRTY_INVENTORY),
    "inventory_transactions": ("events", DIRTY_INVENTORY_TRANSACTIONS),
    "purchase_orders": ("orders", DIRTY_PURCHASE_ORDERS),
}

# Keyword map for the fixtures, in order; "old" also hits "cold", on purpose.
FIXTURE_KEYWORDS = {
    "old": "Standard",
    "bolt": "Economy",
    "gear": "Medium",
    "rod": "Promo",
    "ring": "Small",
    "anvil": "Large",
}


def unnormalized(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture before NA-like tokens become NULL."""
    table, sql = FIXTURES[name]
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    text = sql.replace("{five}", "explode(sequence(1, 5))")
    return spark.sql(text, **{table: source})


class DirtyFrames(Mapping[str, DataFrame]):
    """The five dirty tables of one scale factor; a table is set up when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            raw = unnormalized(self._spark, self._sf_dir, name)
            self._frames[name] = normalize_nulls(raw)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(FIXTURES)

    def __len__(self) -> int:
        return len(FIXTURES)
