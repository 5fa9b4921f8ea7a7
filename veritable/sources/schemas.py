"""The five entities: raw columns (all text), keys and staging types."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

#: Quantities and prices: the widest decimal, with room for ten places. ``lost_casts`` finds what
#: does not fit exactly; another scale per column goes into ``Entity.typed``.
QUANTITY = "decimal(38,10)"


@dataclass(frozen=True)
class Entity:
    """One source table. ``typed`` names the staging columns that are not text."""

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    typed: dict[str, str] = field(default_factory=dict)

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            "products",
            ("sku", "product_name", "category", "price", "supplier_id"),
            ("sku",),
            {"price": QUANTITY},
        ),
        Entity(
            "suppliers",
            ("supplier_id", "name", "lead_time_days", "reliability_score"),
            ("supplier_id",),
        ),
        Entity(
            "inventory",
            ("sku", "warehouse_id", "current_stock", "safety_stock", "last_updated"),
            ("sku", "warehouse_id"),
            {"current_stock": QUANTITY, "safety_stock": QUANTITY, "last_updated": "date"},
        ),
        Entity(
            "inventory_transactions",
            (
                "transaction_id", "sku", "warehouse_id", "transaction_type",
                "quantity_change", "timestamp",
            ),
            ("transaction_id",),
        ),
        Entity(
            "purchase_orders",
            (
                "purchase_order_id", "supplier_id", "sku", "qty_ordered", "order_date",
                "expected_delivery_date", "delivery_status",
            ),
            ("purchase_order_id",),
            {"qty_ordered": QUANTITY, "order_date": "date", "expected_delivery_date": "date"},
        ),
    )
}
