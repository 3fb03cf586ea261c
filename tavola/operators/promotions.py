"""Promoted and never promoted items, traps and dependency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tavola.functions.columns import day, exact_sum, in_cents, percent
from tavola.functions.filters import sold_lines
from tavola.functions.lines import completed_lines


def _performance(
    lines: DataFrame, menu: DataFrame, promotions: DataFrame, how: str
) -> DataFrame:
    sales = lines.groupBy("item_id").agg(
        F.sum("quantity").alias("qty_sold"), exact_sum("line_total").alias("line_sum")
    )
    promoted = promotions.select("item_id").distinct()
    revenue = in_cents(F.col("line_sum"))
    return (
        sales.join(promoted, "item_id", how)
        .join(menu.select("item_id", "cost"), "item_id")
        .select(
            "item_id",
            "qty_sold",
            revenue.alias("revenue"),
            F.round(revenue - F.col("qty_sold") * F.col("cost"), 2).alias("total_profit"),
        )
    )


def promotion_performance(
    items: DataFrame, orders: DataFrame, menu: DataFrame, promotions: DataFrame
) -> DataFrame:
    return promotion_performance_of(completed_lines(items, orders), menu, promotions)


def promotion_performance_of(
    lines: DataFrame, menu: DataFrame, promotions: DataFrame
) -> DataFrame:
    """Completed sales and profit of the items that were ever promoted."""
    return _performance(lines, menu, promotions, "left_semi")


def nonpromoted_performance(
    items: DataFrame, orders: DataFrame, menu: DataFrame, promotions: DataFrame
) -> DataFrame:
    return nonpromoted_performance_of(completed_lines(items, orders), menu, promotions)


def nonpromoted_performance_of(
    lines: DataFrame, menu: DataFrame, promotions: DataFrame
) -> DataFrame:
    """The same of the items that never were."""
    return _performance(lines, menu, promotions, "left_anti")


def promo_traps(performance: DataFrame, min_qty: int = 5000, max_margin: float = 0.4) -> DataFrame:
    """Promoted items that sell a lot and keep little."""
    margin = F.try_divide(F.col("total_profit"), F.col("revenue"))
    return performance.filter((F.col("qty_sold") > min_qty) & (margin < max_margin))


def promotion_dependency(items: DataFrame, promotions: DataFrame) -> DataFrame:
    """Share of an item's quantity sold while it has any promotion at all.

    Promotion dates play no part, so the share is 100 or 0.
    """
    total = sold_lines(items).groupBy("item_id").agg(F.sum("quantity").alias("total_qty"))
    promoted = promotions.select("item_id").distinct().withColumn("promoted", F.lit(True))
    promo_qty = F.when(F.col("promoted"), F.col("total_qty")).otherwise(0)
    return (
        total.join(promoted, "item_id", "left")
        .withColumn("promo_qty", promo_qty)
        .drop("promoted")
        .withColumn("promo_dependency_pct", percent("promo_qty", "total_qty"))
    )


def promotion_dependency_in_window(
    items: DataFrame, orders: DataFrame, promotions: DataFrame
) -> DataFrame:
    """Share of an item's quantity ordered on a day one of its promotions ran.

    A day is promoted when, of the promotions that began up to it, the one that lasts
    longest has not ended: a running maximum along the item's days, so overlapping
    promotions count a line once and the length of a promotion costs nothing. Both sides
    are reduced to one row per item and day first, so an item has no more rows than the
    calendar has days, whatever its share of all lines.
    """
    sold = (
        sold_lines(items)
        .select("order_id", "item_id", "quantity")
        .join(orders.select("order_id", day("order_date").alias("day")), "order_id", "left")
        .groupBy("item_id", "day")
        .agg(F.sum("quantity").alias("qty"))
        .withColumn("until", F.lit(None).cast("date"))
    )
    started = (
        promotions.filter(F.col("start_date") <= F.col("end_date"))
        .groupBy("item_id", F.col("start_date").alias("day"))
        .agg(F.max("end_date").alias("until"))
        .withColumn("qty", F.lit(None).cast("bigint"))
    )
    up_to_day = Window.partitionBy("item_id").orderBy("day").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        sold.unionByName(started)
        .withColumn("until", F.max("until").over(up_to_day))
        .filter(F.col("qty").isNotNull())
        .groupBy("item_id")
        .agg(
            F.sum("qty").alias("total_qty"),
            F.sum(F.when(F.col("until") >= F.col("day"), F.col("qty")).otherwise(0)).alias("promo_qty"),
        )
        .withColumn("promo_dependency_pct", percent("promo_qty", "total_qty"))
    )
