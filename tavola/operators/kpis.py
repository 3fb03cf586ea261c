"""Headline figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import day, money_avg, money_sum, one_row_to_rows
from tavola.functions.filters import paid


def _values(df: DataFrame, **measures) -> DataFrame:
    row = df.agg(*(c.cast("double").alias(name) for name, c in measures.items()))
    return one_row_to_rows(row, "metric", "value")


def paid_totals(orders: DataFrame) -> DataFrame:
    """Sum, count, customers and average of paid orders, as ``(metric, value)``."""
    return _values(
        paid(orders),
        total_revenue=money_sum("total_amount"),
        total_orders=F.count("*"),
        unique_customers=F.countDistinct("customer_id"),
        avg_order_value=money_avg("total_amount"),
    )


def master_kpis(
    orders: DataFrame, menu: DataFrame, wastage: DataFrame, ratings: DataFrame
) -> DataFrame:
    """Company figures as ``(metric, value)``, one aggregate per table."""
    return master_kpis_of(paid_totals(orders), menu, wastage, ratings)


def master_kpis_of(
    totals: DataFrame, menu: DataFrame, wastage: DataFrame, ratings: DataFrame
) -> DataFrame:
    """The same from the totals of paid orders, as ``(metric, value)`` rows."""
    return (
        totals.unionByName(_values(menu, total_menu_items=F.count("*")))
        .unionByName(_values(wastage, total_wastage_cost=money_sum("cost")))
        .unionByName(_values(ratings, avg_rating=F.avg("rating")))
    )


def executive_kpis(orders: DataFrame) -> DataFrame:
    """Figures of a filtered order set, whatever the status of its orders."""
    return orders.agg(
        money_sum("total_amount").alias("total_revenue"),
        F.count("*").alias("total_orders"),
        money_avg("total_amount").alias("avg_order_value"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )


def daily_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy(day("order_date").alias("date")).agg(
        money_sum("total_amount").alias("revenue")
    )


def channel_mix(orders: DataFrame) -> DataFrame:
    return orders.groupBy("channel").agg(money_sum("total_amount").alias("revenue"))
