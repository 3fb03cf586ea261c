"""Declared schemas of the source tables; nothing is inferred from CSV text."""

from __future__ import annotations

from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"

_DDL = {
    "orders": "order_id string, customer_id string, location_id string, order_date timestamp, "
    "channel string, total_amount double, status string",
    "order_items": "order_line_id string, order_id string, item_id string, quantity int, "
    "unit_price double, line_total double",
    "menu_items": "item_id string, item_name string, category string, cost double, "
    "base_price double, is_available boolean",
    "menu_categories": "category_id int, category_name string",
    "restaurants": "location_id string, location_name string, city string, is_active boolean",
    "customers": "customer_id string, name string, email string, phone string, city string, "
    "signup_date date, preferred_channel string",
    "pricing_history": "price_id string, item_id string, old_price double, new_price double, "
    "change_date date",
    "promotions": "promo_id string, item_id string, discount_pct int, start_date date, "
    "end_date date",
    "ratings": "rating_id string, order_id string, customer_id string, item_id string, "
    "rating int, rating_date date",
    "inventory": "inventory_id string, location_id string, item_id string, stock_qty int, "
    "reorder_level int",
    "wastage": "wastage_id string, item_id string, location_id string, quantity int, "
    "cost double, wastage_date date, reason string",
}

TABLES = tuple(_DDL)


def schema_of(table: str, with_corrupt: bool = False) -> StructType:
    schema = StructType.fromDDL(_DDL[table])
    return schema.add(CORRUPT, "string") if with_corrupt else schema
