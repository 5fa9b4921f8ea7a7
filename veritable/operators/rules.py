"""Quality rules as data: what to test, on which table, and how to describe a violation.

Two catalogs are given. ``sql_rules`` logs one row per record and rule. ``cell_rules`` logs
one row per bad cell and counts only surplus duplicates. A user adds a rule by appending a
spec to either list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritable.functions import dates, text
from veritable.functions.numbers import to_number


@dataclass(frozen=True)
class Rule:
    table: str
    record_id: str
    dimension: str
    name: str


@dataclass(frozen=True)
class RowRule(Rule):
    """Decided by the record alone. ``violated`` may be NULL, which means not violated."""

    violated: Column
    detail: Column
    #: Columns that ``violated`` reads and that are computed once per record for all rules.
    derived: tuple[tuple[str, Column], ...] = ()


@dataclass(frozen=True)
class UniqueRule(Rule):
    """Records that agree on ``keys`` (NULL equals NULL).

    ``surplus_only`` leaves out one record of each group: the first by ``order``, then id.
    Rows in a distributed table have no position, so the order has to be stated.
    """

    keys: tuple[str, ...]
    detail: str
    surplus_only: bool = False
    order: Column | None = None


@dataclass(frozen=True)
class ForeignKeyRule(Rule):
    """Records whose non-NULL ``column`` is missing from ``parent.parent_column``."""

    column: str
    parent: str
    parent_column: str
    trimmed: bool = False

    def normalized(self, c: Column) -> Column:
        return F.trim(c) if self.trimmed else c

    @property
    def detail(self) -> Column:
        return F.concat(F.lit(f"{self.column} "), F.col(self.column),
                        F.lit(f" not found in {self.parent}"))


def _quoted(column: str, suffix: str = "") -> Column:
    return F.concat(F.lit(f'{column} = "'), F.col(column), F.lit(f'"{suffix}'))


def missing_any(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def first_missing(columns: Sequence[str]) -> Column:
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])


# Required fields and primary date formats, by table.
REQUIRED = {
    "products": ("category", "price", "supplier_id"),
    "purchase_orders": ("qty_ordered", "order_date", "delivery_status"),
}
DATE_FORMATS = {
    "purchase_orders": {"order_date": dates.DMY, "expected_delivery_date": dates.DMY},
    "inventory": {"last_updated": dates.YMD},
    "inventory_transactions": {"timestamp": dates.ISO_SECONDS},
}
CANONICAL_PREFIX = "SKU"

_RECORD_ID = {
    "products": "sku",
    "purchase_orders": "purchase_order_id",
    "inventory_transactions": "transaction_id",
    "inventory": "sku",
}


def _required(table: str) -> RowRule:
    columns = REQUIRED[table]
    return RowRule(table, _RECORD_ID[table], "completeness", "missing_required_field",
                   missing_any(columns), first_missing(columns))


def _upper_mismatch(column: str) -> Column:
    return F.col(column) != F.upper(F.trim(F.col(column)))


def _sign_mismatch() -> Column:
    kind = F.upper(F.trim("transaction_type"))
    change = to_number(F.col("quantity_change"))
    return ((kind == "OUTBOUND") & (change > 0)) | ((kind == "INBOUND") & (change < 0))


def _read_date(column: str) -> tuple[str, Column]:
    return f"_{column}_read", dates.flexible_date(F.col(column))


def _off_format_but_readable(column: str) -> Column:
    shape = r"^[0-9]{2}-[0-9]{2}-[0-9]{4}\z"
    return ~F.col(column).rlike(shape) & F.col(f"_{column}_read").isNotNull()


def sql_rules() -> list[Rule]:
    """Twelve rules in five dimensions."""
    product, order, transaction = (
        ("products", "sku"),
        ("purchase_orders", "purchase_order_id"),
        ("inventory_transactions", "transaction_id"),
    )
    prefix = text.leading_letters(F.col("sku"))
    return [
        _required("products"),
        _required("purchase_orders"),
        UniqueRule(*product, "uniqueness", "duplicate_product_supplier",
                   ("product_name", "supplier_id"),
                   "duplicate (product_name, supplier_id) pair"),
        ForeignKeyRule(*product, "validity", "orphan_supplier_id",
                       "supplier_id", "suppliers", "supplier_id", trimmed=True),
        RowRule(*product, "validity", "non_positive_price",
                to_number(F.col("price")) <= 0, F.concat(F.lit("price = "), F.col("price"))),
        RowRule(*product, "consistency", "non_canonical_category",
                text.differs_from_initcap(F.col("category")), _quoted("category")),
        RowRule(*order, "consistency", "non_canonical_delivery_status",
                text.differs_from_initcap(F.col("delivery_status")), _quoted("delivery_status")),
        RowRule(*transaction, "consistency", "non_canonical_transaction_type",
                _upper_mismatch("transaction_type"), _quoted("transaction_type")),
        RowRule(*product, "consistency", "non_standard_sku_prefix",
                prefix != CANONICAL_PREFIX, F.concat(F.lit("prefix = "), prefix)),
        RowRule(*order, "consistency", "non_primary_date_format",
                _off_format_but_readable("order_date"),
                _quoted("order_date", " did not match DD-MM-YYYY"), (_read_date("order_date"),)),
        RowRule(*order, "accuracy", "delivery_before_order",
                F.col("_expected_delivery_date_read") < F.col("_order_date_read"),
                F.lit("expected_delivery_date before order_date"),
                (_read_date("order_date"), _read_date("expected_delivery_date"))),
        RowRule(*transaction, "accuracy", "sign_mismatch", _sign_mismatch(),
                F.concat(F.col("transaction_type"), F.lit(" with quantity_change = "),
                         F.col("quantity_change"))),
    ]


def cell_rules(first: Column | None = None) -> list[Rule]:
    """One violation per bad cell; off-format dates count as accuracy, on three columns.

    ``first`` says which of several equal products is not surplus: the one where it is least, such as
    ``row_number`` of a numbered load. By default the key without its prefix decides.
    """
    rules: list[Rule] = []
    for table, columns in REQUIRED.items():
        for c in columns:
            rules.append(RowRule(table, _RECORD_ID[table], "completeness", f"missing_{c}",
                                 F.col(c).isNull(), F.lit(c)))
    rules += [
        UniqueRule("products", "sku", "uniqueness", "surplus_product_supplier",
                   ("product_name", "supplier_id"),
                   "duplicate (product_name, supplier_id) pair", surplus_only=True,
                   order=first if first is not None else text.without_prefix(F.col("sku"))),
        ForeignKeyRule("products", "sku", "validity", "orphan_supplier_id",
                       "supplier_id", "suppliers", "supplier_id"),
        RowRule("products", "sku", "consistency", "non_canonical_category",
                text.differs_from_title(F.col("category")), _quoted("category")),
        RowRule("purchase_orders", "purchase_order_id", "consistency",
                "non_canonical_delivery_status",
                text.differs_from_title(F.col("delivery_status")), _quoted("delivery_status")),
        RowRule("inventory_transactions", "transaction_id", "consistency",
                "non_canonical_transaction_type",
                F.col("transaction_type") != F.upper(text.strip(F.col("transaction_type"))),
                _quoted("transaction_type")),
    ]
    for table in ("purchase_orders", "inventory"):
        for c, fmt in DATE_FORMATS[table].items():
            rules.append(RowRule(table, _RECORD_ID[table], "accuracy", f"off_format_{c}",
                                 dates.parse_fails(F.col(c), fmt), _quoted(c)))
    return rules


# The view each rule is published as, by (table, rule name).
VIEW_NAMES = {
    ("products", "missing_required_field"): "v_completeness_products",
    ("purchase_orders", "missing_required_field"): "v_completeness_purchase_orders",
    ("products", "duplicate_product_supplier"): "v_uniqueness_products",
    ("products", "orphan_supplier_id"): "v_validity_orphan_supplier",
    ("products", "non_positive_price"): "v_validity_price_range",
    ("products", "non_canonical_category"): "v_consistency_category",
    ("purchase_orders", "non_canonical_delivery_status"): "v_consistency_delivery_status",
    ("inventory_transactions", "non_canonical_transaction_type"):
        "v_consistency_transaction_type",
    ("products", "non_standard_sku_prefix"): "v_consistency_sku_prefix",
    ("purchase_orders", "non_primary_date_format"): "v_consistency_date_format",
    ("purchase_orders", "delivery_before_order"): "v_accuracy_po_dates",
    ("inventory_transactions", "sign_mismatch"): "v_accuracy_transaction_sign",
}


def view_name(rule: Rule) -> str:
    return VIEW_NAMES.get((rule.table, rule.name), f"v_{rule.dimension}_{rule.table}_{rule.name}")


RULESETS = {"sql": sql_rules, "cell": cell_rules}


def select_rules(
    rules: Sequence[Rule], table: str | None = None, dimension: str | None = None
) -> list[Rule]:
    return [r for r in rules
            if table in (None, r.table) and dimension in (None, r.dimension)]
