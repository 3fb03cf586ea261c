"""Item profitability and the four-quadrant classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import (
    cents,
    money_avg,
    money_sum,
    null_safe_join,
    percent,
    share_shuffle,
    top_k,
)
from tavola.functions.fixed import (
    HIDDEN_OPPORTUNITY,
    LOW_PERFORMER,
    PROFIT_DRIVER,
    VOLUME_DRIVER,
)
from tavola.functions.lines import completed_lines, sold_and_paid


def _margin(revenue: str, cost: Column) -> dict[str, Column]:
    """total_cost, profit and profit_pct from a revenue column and a cost."""
    total_cost = F.round(cost, 2)
    profit = F.round(F.col(revenue) - total_cost, 2)
    pct = F.when(F.col(revenue) > 0, percent(profit, revenue)).otherwise(0.0)
    return {"total_cost": total_cost, "profit": profit, "profit_pct": pct}


def menu_profitability(items: DataFrame, orders: DataFrame, menu: DataFrame) -> DataFrame:
    return menu_profitability_of(completed_lines(items, orders), menu)


def menu_profitability_of(lines: DataFrame, menu: DataFrame) -> DataFrame:
    """Sales, cost and margin per menu item, over sold lines of paid orders.

    Lines are reduced to one row per item before they meet the menu, so a
    best-seller costs one partial row per task in that shuffle.
    """
    sales = (
        sold_and_paid(lines)
        .groupBy("item_id")
        .agg(
            F.sum("quantity").alias("qty_sold"),
            F.count("order_id").alias("order_count"),
            money_sum("line_total").alias("revenue"),
        )
    )
    card = menu.select("item_id", "item_name", "category", "cost", "base_price")
    margin = _margin("revenue", F.col("qty_sold") * F.col("cost"))
    return card.join(sales, "item_id").select(
        *card.columns,
        "qty_sold",
        "revenue",
        "order_count",
        *(c.alias(name) for name, c in margin.items()),
    )


def _quadrant(sells: Column, earns: Column) -> Column:
    """The four classes in order; an unknown quantity or margin passes no test."""
    return (
        F.when(sells & earns, PROFIT_DRIVER)
        .when(sells & ~earns, VOLUME_DRIVER)
        .when(~sells & earns, HIDDEN_OPPORTUNITY)
        .otherwise(LOW_PERFORMER)
    )


def classify_quadrant(items: DataFrame) -> DataFrame:
    """Add ``performance_class``: at or above the average quantity and margin.

    The averages are over items, not weighted by sales. They are scalar
    subqueries, so nothing is collected and no row goes to a single task.
    """
    sold = share_shuffle(items, "order_count")
    avg_qty = sold.agg(F.avg("qty_sold")).scalar()
    avg_margin = sold.agg(F.sum(cents("profit_pct")) / F.count("profit_pct")).scalar()
    return items.withColumn(
        "performance_class",
        _quadrant(F.col("qty_sold") >= avg_qty, cents("profit_pct") >= avg_margin),
    )


def menu_classified(items: DataFrame, orders: DataFrame, menu: DataFrame) -> DataFrame:
    return classify_quadrant(menu_profitability(items, orders, menu))


def class_summary(classified: DataFrame) -> DataFrame:
    counts = classified.groupBy("performance_class").agg(F.count("*").alias("items"))
    return counts.orderBy(F.desc("items"), "performance_class")


def location_menu(items: DataFrame, orders: DataFrame) -> DataFrame:
    return location_menu_of(completed_lines(items, orders))


def location_menu_of(lines: DataFrame) -> DataFrame:
    """Quantity per location and item."""
    sold = sold_and_paid(lines)
    return sold.groupBy("location_id", "item_id").agg(F.sum("quantity").alias("qty_sold"))


def location_menu_classified(items: DataFrame, orders: DataFrame, menu: DataFrame) -> DataFrame:
    return location_menu_classified_of(completed_lines(items, orders), menu)


def location_menu_classified_of(lines: DataFrame, menu: DataFrame) -> DataFrame:
    """The quadrant rule inside each location.

    The location averages are an aggregate joined back: it holds one row per
    location, while a window would sort a whole location in one task. Orders without a
    location are a location of their own.
    """
    sales = (
        sold_and_paid(lines)
        .groupBy("location_id", "item_id")
        .agg(F.sum("quantity").alias("qty_sold"), money_sum("line_total").alias("revenue"))
        .join(menu.select("item_id", "cost"), "item_id")
    )
    margin = _margin("revenue", F.col("qty_sold") * F.col("cost"))
    per_item = sales.select(
        "location_id",
        "item_id",
        "qty_sold",
        "revenue",
        *(c.alias(name) for name, c in margin.items()),
    )
    averages = per_item.groupBy("location_id").agg(
        F.avg("qty_sold").alias("avg_qty"),
        (F.sum(cents("profit_pct")) / F.count("profit_pct")).alias("avg_cents"),
        money_avg("profit_pct").alias("avg_profit"),
    )
    sells = F.col("qty_sold") >= F.col("avg_qty")
    earns = cents("profit_pct") >= F.col("avg_cents")
    return (
        null_safe_join(per_item, averages, "location_id")
        .withColumn("loc_class", _quadrant(sells, earns))
        .drop("avg_cents")
    )


def top_profit_items(classified: DataFrame, k: int = 10) -> DataFrame:
    columns = (
        "item_id",
        "item_name",
        "qty_sold",
        "revenue",
        "profit",
        "profit_pct",
        "performance_class",
    )
    return top_k(classified.select(*columns), k, F.desc("profit"), F.asc("item_id"))


def promote_candidates(classified: DataFrame, k: int = 5) -> DataFrame:
    """The hidden opportunities with the best margin."""
    hidden = classified.filter(F.col("performance_class") == HIDDEN_OPPORTUNITY)
    columns = hidden.select("item_id", "item_name", "profit_pct")
    return top_k(columns, k, F.desc("profit_pct"), F.asc("item_id"))
