"""Unusual sales days and suspicious ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import day, money_sum, share_shuffle, top_k


def sales_anomalies(orders: DataFrame, z: float = 2.5) -> DataFrame:
    """Days whose revenue lies more than ``z`` standard deviations off the mean.

    All orders count, whatever their status. Equal days have no deviation and
    give no rows.
    """
    daily = orders.groupBy(day("order_date").alias("order_date")).agg(
        F.count("order_id").alias("order_count"),
        money_sum("total_amount").alias("daily_revenue"),
    )
    days = share_shuffle(daily, "order_count")
    mean = days.agg(F.avg("daily_revenue")).scalar()
    spread = days.agg(F.stddev_samp("daily_revenue")).scalar()
    score = F.try_divide(F.abs(F.col("daily_revenue") - mean), spread)
    return daily.select(
        "order_date", "daily_revenue", "order_count", F.round(score, 6).alias("z_score")
    ).filter(F.col("z_score") > z)


def top_anomalies(anomalies: DataFrame, k: int = 10) -> DataFrame:
    return top_k(anomalies, k, F.desc("z_score"), F.asc("order_date"))


def rating_anomalies(ratings: DataFrame, min_count: int = 100, max_std: float = 0.5) -> DataFrame:
    """Items with many ratings that hardly differ."""
    return (
        ratings.groupBy("item_id")
        .agg(
            F.avg("rating").alias("avg_rating"),
            F.count("rating").alias("rating_count"),
            F.round(F.stddev_samp("rating"), 6).alias("rating_std"),
        )
        .filter((F.col("rating_count") > min_count) & (F.col("rating_std") < max_std))
    )
