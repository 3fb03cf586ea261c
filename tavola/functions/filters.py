"""The row filters that decide which orders and lines an operator looks at."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.fixed import COMPLETED


def completed(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") == COMPLETED)


def paid(orders: DataFrame) -> DataFrame:
    """Completed orders with a positive amount."""
    return completed(orders).filter(F.col("total_amount") > 0)


def sold_lines(items: DataFrame) -> DataFrame:
    return items.filter(F.col("quantity") > 0)


def filter_orders(
    orders: DataFrame,
    date_from: date | None = None,
    date_to: date | None = None,
    location=None,
    channel: str | None = None,
) -> DataFrame:
    """Orders of an inclusive date range, a location and a channel; None means all.

    The range is put on the raw column, so that it reaches the Parquet scan.
    """
    if date_from is not None:
        orders = orders.filter(F.col("order_date") >= F.lit(date_from))
    if date_to is not None:
        orders = orders.filter(F.col("order_date") < F.lit(date_to + timedelta(days=1)))
    if location is not None:
        orders = orders.filter(F.col("location_id") == F.lit(location))
    if channel is not None:
        orders = orders.filter(F.col("channel") == channel)
    return orders


def filter_menu(
    classified: DataFrame,
    classes: Iterable[str] | None = None,
    categories: Iterable[str] | None = None,
) -> DataFrame:
    """Classified items of the chosen classes and categories; None means all."""
    if classes is not None:
        classified = classified.filter(F.col("performance_class").isin(*classes))
    if categories is not None:
        classified = classified.filter(F.col("category").isin(*categories))
    return classified
