"""Order lines with their completed order: the one large join of the model.

Operators that need both take either the two tables, or, as ``..._of``, the joined
lines. A run that builds many results stores the joined lines once, and no result
shuffles lines by order again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.filters import completed

LINE_COLUMNS = ("item_id", "quantity", "line_total")
ORDER_COLUMNS = ("customer_id", "location_id", "order_date", "channel", "total_amount")


def completed_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of completed orders, with the columns of the order that it has."""
    known = [c for c in ORDER_COLUMNS if c in orders.columns]
    lines = items.select("order_id", *LINE_COLUMNS)
    return lines.join(completed(orders).select("order_id", *known), "order_id")


def sold_and_paid(lines: DataFrame) -> DataFrame:
    """Lines with a positive quantity, of orders with a positive amount."""
    return lines.filter((F.col("quantity") > 0) & (F.col("total_amount") > 0))
