"""Ordering channels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import exact_sum, money_avg, money_sum
from tavola.functions.filters import paid
from tavola.functions.lines import completed_lines, sold_and_paid


def channel_analysis(orders: DataFrame) -> DataFrame:
    return (
        paid(orders)
        .groupBy("channel")
        .agg(
            F.count("order_id").alias("total_orders"),
            money_sum("total_amount").alias("revenue"),
            F.round(money_avg("total_amount"), 2).alias("avg_order_value"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
    )


def channel_detailed(
    items: DataFrame, orders: DataFrame, distinct_orders: bool = False
) -> DataFrame:
    return channel_detailed_of(completed_lines(items, orders), distinct_orders)


def channel_detailed_of(lines: DataFrame, distinct_orders: bool = False) -> DataFrame:
    """Line-level channel figures.

    ``total_orders`` counts lines; ``distinct_orders=True`` counts orders instead. Lines are
    reduced to one row per channel and item, so that counting the items expands no line.
    """
    sold = sold_and_paid(lines)
    per_item = sold.groupBy("channel", "item_id").agg(
        F.sum("quantity").alias("qty"),
        F.count("order_id").alias("order_lines"),
        F.count("line_total").alias("priced"),
        exact_sum("line_total").alias("line_sum"),
    )
    figures = per_item.groupBy("channel").agg(
        F.sum("qty").alias("total_qty"),
        F.sum("order_lines").alias("total_orders"),
        F.round(
            F.try_divide(F.sum("line_sum").cast("double"), F.sum("priced")), 2
        ).alias("avg_line_value"),
        F.count("item_id").alias("unique_items"),
    )
    if distinct_orders:
        orders = (
            sold.groupBy("channel", "order_id")
            .agg(F.count("*").alias("order_lines"))
            .groupBy(F.col("channel").alias("in_channel"))
            .agg(F.count("order_id").alias("total_orders"))
        )
        same = F.col("channel").eqNullSafe(F.col("in_channel"))
        figures = figures.drop("total_orders").join(orders, same).drop("in_channel")
    return figures.select(
        "channel",
        "total_qty",
        "total_orders",
        "avg_line_value",
        "unique_items",
        F.round(F.try_divide(F.col("total_qty"), F.col("total_orders")), 2).alias("avg_basket_size"),
    )


def channel_item_qty(items: DataFrame, orders: DataFrame) -> DataFrame:
    return channel_item_qty_of(completed_lines(items, orders))


def channel_item_qty_of(lines: DataFrame) -> DataFrame:
    sold = sold_and_paid(lines)
    return sold.groupBy("channel", "item_id").agg(F.sum("quantity").alias("qty"))
