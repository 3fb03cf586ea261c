"""Ratings per item, location, margin and promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import percent, top_k


def rating_analysis(ratings: DataFrame) -> DataFrame:
    return (
        ratings.groupBy("item_id")
        .agg(
            F.avg("rating").alias("avg_rating"),
            F.count("rating").alias("total_ratings"),
            F.count_if(F.col("rating") >= 4).alias("positive_ratings"),
            F.count_if(F.col("rating") <= 2).alias("negative_ratings"),
        )
        .withColumn("satisfaction_pct", percent("positive_ratings", "total_ratings"))
    )


def rating_by_location(ratings: DataFrame, orders: DataFrame) -> DataFrame:
    """Ratings of unknown orders form the null location.

    Ratings are reduced to one row per order before the join.
    """
    per_order = ratings.groupBy("order_id").agg(
        F.sum("rating").alias("points"), F.count("rating").alias("ratings")
    )
    return (
        per_order.join(orders.select("order_id", "location_id"), "order_id", "left")
        .groupBy("location_id")
        .agg(
            F.try_divide(F.sum("points"), F.sum("ratings")).alias("avg_rating"),
            F.sum("ratings").alias("total_ratings"),
        )
    )


def _average(ratings: DataFrame, name: str) -> DataFrame:
    return ratings.groupBy("item_id").agg(F.avg("rating").alias(name))


def rating_vs_profit(ratings: DataFrame, classified: DataFrame) -> DataFrame:
    """Average rating beside the margin; ``classified`` has one row per item."""
    margin = classified.select("item_id", F.col("profit_pct").alias("avg_profit_pct"))
    return _average(ratings, "avg_rating").join(margin, "item_id", "left")


def rating_by_promotion(ratings: DataFrame, promotions: DataFrame) -> DataFrame:
    """Average rating of the items that were ever promoted."""
    promoted = promotions.select("item_id").distinct()
    return _average(ratings, "promoted_rating").join(promoted, "item_id", "left_semi")


def _rated_often(ratings: DataFrame, more_than: int) -> DataFrame:
    return (
        ratings.groupBy("item_id")
        .agg(F.avg("rating").alias("avg_rating"), F.count("rating").alias("total_ratings"))
        .filter(F.col("total_ratings") > more_than)
    )


def best_rated(ratings: DataFrame, k: int = 10, more_than: int = 10) -> DataFrame:
    often = _rated_often(ratings, more_than)
    return top_k(often, k, F.desc("avg_rating"), F.asc("item_id"))


def worst_rated(ratings: DataFrame, k: int = 10, more_than: int = 10) -> DataFrame:
    often = _rated_often(ratings, more_than)
    return top_k(often, k, F.asc("avg_rating"), F.asc("item_id"))
