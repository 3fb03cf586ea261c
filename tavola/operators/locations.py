"""Comparison of locations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import exact_sum, in_cents, money_avg, money_sum, null_safe_join, percent, top_k
from tavola.functions.filters import completed
from tavola.functions.lines import completed_lines


def location_comparison(
    orders: DataFrame, items: DataFrame, menu: DataFrame, wastage: DataFrame
) -> DataFrame:
    return location_comparison_of(orders, completed_lines(items, orders), menu, wastage)


def location_comparison_of(
    orders: DataFrame, lines: DataFrame, menu: DataFrame, wastage: DataFrame
) -> DataFrame:
    """Revenue, profit and wastage per location, over completed orders.

    ``revenue`` comes from order totals, ``gross_revenue`` from their lines.
    Lines are reduced to one row per location and item before the cost join. Orders
    without a location are a row of their own.
    """
    takings = completed(orders).groupBy("location_id").agg(
        money_sum("total_amount").alias("revenue"),
        F.count("order_id").alias("total_orders"),
        money_avg("total_amount").alias("avg_order_value"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    return compare_takings(takings, lines, menu, wastage)


def compare_takings(
    takings: DataFrame, lines: DataFrame, menu: DataFrame, wastage: DataFrame
) -> DataFrame:
    """``takings`` (revenue, orders and customers per location) beside profit and wastage."""
    profit = (
        lines.groupBy("location_id", "item_id")
        .agg(F.sum("quantity").alias("qty"), exact_sum("line_total").alias("line_sum"))
        .join(menu.select("item_id", "cost"), "item_id")
        .groupBy("location_id")
        .agg(
            in_cents(F.sum("line_sum")).alias("gross_revenue"),
            money_sum(F.col("qty") * F.col("cost")).alias("total_cost"),
        )
        .withColumn("profit", F.round(F.col("gross_revenue") - F.col("total_cost"), 2))
    )
    waste = wastage.groupBy("location_id").agg(
        F.sum("quantity").alias("total_wasted_qty"),
        money_sum("cost").alias("wastage_cost"),
    )
    return (
        null_safe_join(null_safe_join(takings, profit, "location_id", "left"), waste, "location_id", "left")
        .fillna(
            0,
            subset=[
                "revenue",
                "avg_order_value",
                "gross_revenue",
                "total_cost",
                "profit",
                "total_wasted_qty",
                "wastage_cost",
            ],
        )
        .withColumn("profit_margin_pct", percent("profit", "revenue"))
    )


def top_locations(comparison: DataFrame, k: int = 10) -> DataFrame:
    columns = ("location_id", "revenue", "total_orders", "avg_order_value", "profit_margin_pct")
    return top_k(comparison.select(*columns), k, F.desc("revenue"), F.asc("location_id"))


def worst_locations(comparison: DataFrame, k: int = 5) -> DataFrame:
    columns = ("location_id", "revenue", "total_orders", "avg_order_value", "profit_margin_pct")
    return top_k(comparison.select(*columns), k, F.asc("profit_margin_pct"), F.asc("location_id"))
