"""Price sensitivity and the price what-if."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import band, six_digit_avg, top_k
from tavola.functions.fixed import PRICE_BANDS, PRICE_REST


def price_sensitivity(items: DataFrame, pricing: DataFrame) -> DataFrame:
    """Mean selling price against the mean list price in the item's history.

    Items without a history get 0 and fall in the low class.
    """
    sales = items.groupBy("item_id").agg(
        F.sum("quantity").alias("qty_sold"),
        six_digit_avg("unit_price").alias("avg_selling_price"),
    )
    history = pricing.groupBy("item_id").agg(
        six_digit_avg("new_price").alias("avg_price"),
        F.count("price_id").alias("num_price_changes"),
    )
    gap = F.try_divide(F.col("avg_selling_price") - F.col("avg_price"), F.col("avg_price")) * 100
    return (
        sales.join(history, "item_id", "left")
        .fillna(0, subset=["qty_sold", "avg_selling_price", "avg_price", "num_price_changes"])
        .withColumn("price_variation_pct", F.when(F.col("avg_price") > 0, gap).otherwise(0.0))
        .withColumn("sensitivity_class", band("price_variation_pct", PRICE_BANDS, PRICE_REST))
    )


def sensitivity_summary(sensitivity: DataFrame) -> DataFrame:
    return sensitivity.groupBy("sensitivity_class").agg(F.count("*").alias("items"))


def top_price_sensitive(sensitivity: DataFrame, k: int = 10) -> DataFrame:
    (_, highest), *_ = PRICE_BANDS
    high = sensitivity.filter(F.col("sensitivity_class") == highest)
    return top_k(high, k, F.desc("qty_sold"), F.asc("item_id"))


def price_what_if(classified: DataFrame, pct: float) -> DataFrame:
    """List price after a change of ``pct`` percent, quantity left as it is."""
    if not -50 <= pct <= 50:
        raise ValueError("pct must lie between -50 and 50")
    return classified.select(
        "item_id",
        "item_name",
        "base_price",
        (F.col("base_price") * F.lit(1 + pct / 100)).alias("new_price"),
        "qty_sold",
    )
