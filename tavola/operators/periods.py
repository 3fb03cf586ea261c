"""Hours, weekdays, months and seasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import money_sum, season, weekend_flag
from tavola.functions.filters import paid


def _by_period(orders: DataFrame, count_name: str, *keys: Column) -> DataFrame:
    return (
        paid(orders)
        .groupBy(*keys)
        .agg(F.count("order_id").alias(count_name), money_sum("total_amount").alias("revenue"))
    )


def _year(by_year: bool) -> list[Column]:
    return [F.year("order_date").alias("year")] if by_year else []


def peak_hours(orders: DataFrame) -> DataFrame:
    """Orders per hour of the day, taken from the full timestamp."""
    hours = _by_period(orders, "order_count", F.hour("order_date").alias("hour"))
    return hours.orderBy(F.desc("order_count"), "hour")


def peak_days(orders: DataFrame) -> DataFrame:
    """Orders per day of the week, 1 = Sunday."""
    days = _by_period(orders, "order_count", F.dayofweek("order_date").alias("dow"))
    return days.orderBy(F.desc("order_count"), "dow")


def weekend_analysis(orders: DataFrame) -> DataFrame:
    return _by_period(orders, "orders", weekend_flag("order_date").alias("is_weekend"))


def monthly_analysis(orders: DataFrame, by_year: bool = False) -> DataFrame:
    """Months 1 to 12, years merged unless ``by_year``."""
    return _by_period(orders, "orders", *_year(by_year), F.month("order_date").alias("month"))


def seasonal_analysis(orders: DataFrame, by_year: bool = False) -> DataFrame:
    return _by_period(orders, "orders", *_year(by_year), season("order_date").alias("season"))


def orders_with_month(orders: DataFrame) -> DataFrame:
    """Paid orders with the month they are stored under."""
    return paid(orders).withColumn("month", F.month("order_date"))
