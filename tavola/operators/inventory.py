"""Stock advice, best sellers and slow movers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import share_shuffle, top_k
from tavola.functions.filters import sold_lines
from tavola.functions.fixed import REORDER_NOW, STOCK_MONITOR, STOCK_SUFFICIENT


def inventory_recommendations(inventory: DataFrame, watch_factor: float = 1.5) -> DataFrame:
    stock, level = F.col("avg_stock"), F.col("avg_reorder")
    advice = (
        F.when(stock < level, REORDER_NOW)
        .when(stock < level * watch_factor, STOCK_MONITOR)
        .otherwise(STOCK_SUFFICIENT)
    )
    return (
        inventory.groupBy("item_id")
        .agg(F.avg("stock_qty").alias("avg_stock"), F.avg("reorder_level").alias("avg_reorder"))
        .withColumn("recommendation", advice)
    )


def item_volume(items: DataFrame) -> DataFrame:
    return (
        sold_lines(items)
        .groupBy("item_id")
        .agg(F.sum("quantity").alias("total_qty"), F.count("order_id").alias("order_count"))
    )


def top_sellers_of(volume: DataFrame, k: int = 10) -> DataFrame:
    sold = volume.select("item_id", F.col("total_qty").alias("qty"))
    return top_k(sold, k, F.desc("qty"), F.asc("item_id"))


def low_sellers_of(volume: DataFrame, k: int = 10) -> DataFrame:
    sold = volume.select("item_id", F.col("total_qty").alias("qty"))
    return top_k(sold, k, F.asc("qty"), F.asc("item_id"))


def top_sellers(items: DataFrame, k: int = 10) -> DataFrame:
    return top_sellers_of(item_volume(items), k)


def low_sellers(items: DataFrame, k: int = 10) -> DataFrame:
    return low_sellers_of(item_volume(items), k)


def _named(volume: DataFrame, menu: DataFrame) -> DataFrame:
    return volume.join(menu.select("item_id", "item_name", "category"), "item_id").orderBy(
        "total_qty", "item_id"
    )


def slow_moving_threshold(items: DataFrame, menu: DataFrame, frac: float = 0.5) -> DataFrame:
    """Items that sell less than ``frac`` of the average item."""
    return slow_moving_threshold_of(item_volume(items), menu, frac)


def slow_moving_threshold_of(volume: DataFrame, menu: DataFrame, frac: float = 0.5) -> DataFrame:
    average = share_shuffle(volume, "order_count").agg(F.avg("total_qty")).scalar()
    return _named(volume.filter(F.col("total_qty") < average * frac), menu)


def slow_moving_bottom_k(items: DataFrame, menu: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` items that sell least, named after the cut."""
    return slow_moving_bottom_k_of(item_volume(items), menu, k)


def slow_moving_bottom_k_of(volume: DataFrame, menu: DataFrame, k: int = 20) -> DataFrame:
    return _named(top_k(volume, k, F.asc("total_qty"), F.asc("item_id")), menu)
