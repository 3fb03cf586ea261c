"""Wastage by item and dimension, and wastage risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import band, exact_sum, in_cents, money_sum, percent, top_k
from tavola.functions.filters import sold_lines
from tavola.functions.fixed import WASTE_BANDS, WASTE_REST
from tavola.functions.lines import completed_lines


def _share(wasted: str, sold: str) -> Column:
    """Wasted part of what left the kitchen; one is added to keep it defined."""
    return percent(wasted, F.col(wasted) + F.col(sold) + 1)


def wastage_by_item(
    wastage: DataFrame, menu: DataFrame, items: DataFrame, orders: DataFrame
) -> DataFrame:
    return wastage_by_item_of(wastage, menu, completed_lines(items, orders))


def wastage_by_item_of(wastage: DataFrame, menu: DataFrame, lines: DataFrame) -> DataFrame:
    """Every menu item with its wastage and its completed sales, zero when none."""
    wasted = wastage.groupBy("item_id").agg(
        F.sum("quantity").alias("total_wasted_qty"),
        money_sum("cost").alias("total_wastage_cost"),
    )
    sold = lines.groupBy("item_id").agg(F.sum("quantity").alias("total_sold"))
    return (
        menu.join(wasted, "item_id", "left")
        .join(sold, "item_id", "left")
        .fillna(0, subset=["total_wasted_qty", "total_wastage_cost", "total_sold"])
        .withColumn("wastage_pct", _share("total_wasted_qty", "total_sold"))
    )


def _by(wastage: DataFrame, *keys: str | Column) -> DataFrame:
    return wastage.groupBy(*keys).agg(
        F.sum("quantity").alias("total_qty"), money_sum("cost").alias("total_cost")
    )


def wastage_by_location(wastage: DataFrame) -> DataFrame:
    return _by(wastage, "location_id").orderBy(F.desc("total_cost"), "location_id")


def wastage_by_category(wastage: DataFrame, menu: DataFrame) -> DataFrame:
    """Reduced to items first, so a hot item is one row in the menu join."""
    per_item = wastage.groupBy("item_id").agg(
        F.sum("quantity").alias("qty"), exact_sum("cost").alias("cost_sum")
    )
    return (
        per_item.join(menu.select("item_id", "category"), "item_id")
        .groupBy("category")
        .agg(
            F.sum("qty").alias("total_qty"),
            in_cents(F.sum("cost_sum")).alias("total_cost"),
        )
    )


def wastage_by_day(wastage: DataFrame) -> DataFrame:
    """Per day of the week, 1 = Sunday."""
    return _by(wastage, F.dayofweek("wastage_date").alias("dow"))


def wastage_by_reason(wastage: DataFrame) -> DataFrame:
    return _by(wastage, "reason")


def wastage_risk(wastage: DataFrame, items: DataFrame) -> DataFrame:
    """Risk band of every wasted item, against sold lines of any status."""
    wasted = wastage.groupBy("item_id").agg(F.sum("quantity").alias("total_wasted"))
    sold = sold_lines(items).groupBy("item_id").agg(F.sum("quantity").alias("total_sold"))
    return (
        wasted.join(sold, "item_id", "left")
        .fillna(0, subset=["total_wasted", "total_sold"])
        .withColumn("waste_ratio", _share("total_wasted", "total_sold"))
        .withColumn("risk_level", band("waste_ratio", WASTE_BANDS, WASTE_REST))
    )


def top_wastage(by_item: DataFrame, k: int = 10) -> DataFrame:
    columns = (
        "item_id",
        "item_name",
        "total_wasted_qty",
        "total_wastage_cost",
        "wastage_pct",
    )
    return top_k(by_item.select(*columns), k, F.desc("total_wastage_cost"), F.asc("item_id"))


def wastage_headline(by_item: DataFrame, high_pct: float = 10) -> DataFrame:
    return by_item.agg(
        money_sum("total_wastage_cost").alias("total_wastage_cost"),
        F.count_if(F.col("wastage_pct") > high_pct).alias("high_wastage_items"),
    )
