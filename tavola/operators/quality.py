"""Data-quality checks and cleaning."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import one_row_to_rows
from tavola.functions.fixed import CANCELLED, COMPLETED


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percent of every column, in one pass."""
    row = df.agg(
        F.count("*").alias("rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"nulls:{c}") for c in df.columns),
    )
    entries = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(f"`nulls:{c}`").alias("nulls"))
            for c in df.columns
        )
    )
    pct = F.coalesce(F.try_divide(F.col("nulls"), F.col("rows")) * 100, F.lit(0.0))
    return row.select("rows", F.inline(entries)).select(
        "column", "nulls", F.round(pct, 2).alias("pct")
    )


def _missing(df: DataFrame) -> Column:
    """Null cells of one row, over all columns."""
    cells = [F.col(c).isNull().cast("bigint") for c in df.columns]
    total = cells[0]
    for cell in cells[1:]:
        total = total + cell
    return total


def _total(x: Column) -> Column:
    return F.coalesce(F.sum(x), F.lit(0)).cast("bigint")


def missing_total(df: DataFrame) -> DataFrame:
    return df.agg(_total(_missing(df)).alias("missing"))


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    """How many key values occur more than once."""
    copies = df.groupBy(key).agg(F.count("*").alias("copies"))
    return copies.agg(F.count_if(F.col("copies") > 1).alias("duplicates"))


def duplicate_keys(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(table, duplicates)`` for several tables, each given with its key."""
    return _stack(
        [
            duplicate_key_count(df, key).select(F.lit(name).alias("table"), "duplicates")
            for name, (df, key) in tables.items()
        ]
    )


def _stack(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _checks(df: DataFrame, **checks: Column) -> DataFrame:
    row = df.agg(*(c.cast("bigint").alias(name) for name, c in checks.items()))
    return one_row_to_rows(row, "check", "violations")


def _keyed_checks(df: DataFrame, key: str, duplicates: str, **flags: Column) -> DataFrame:
    """Sums of row flags and the number of repeated keys, from one scan and one shuffle.

    Rows become one per key that carries the sums of its flags.
    """
    per_key = df.groupBy(key).agg(
        F.count("*").alias("copies"), *(F.sum(c.cast("bigint")).alias(name) for name, c in flags.items())
    )
    return _checks(
        per_key,
        **{name: _total(F.col(name)) for name in flags},
        **{duplicates: F.count_if(F.col("copies") > 1)},
    )


def invalid_location_refs(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Orders with a location nobody knows; a missing location is not counted.

    Orders are counted per location first, so the anti join sees a row per location.
    """
    known = restaurants.select("location_id").distinct()
    per_location = (
        orders.filter(F.col("location_id").isNotNull())
        .groupBy("location_id")
        .agg(F.count("*").alias("orders"))
    )
    return _checks(
        per_location.join(known, "location_id", "left_anti"),
        invalid_location_refs=_total(F.col("orders")),
    )


def quality_report(
    orders: DataFrame,
    items: DataFrame,
    menu: DataFrame,
    customers: DataFrame,
    ratings: DataFrame,
    wastage: DataFrame,
    restaurants: DataFrame,
    max_wastage: int = 1000,
) -> DataFrame:
    """Fifteen named checks as ``(check, violations)``, from one scan of each table.

    Only tables whose keys are checked are shuffled, by that key. Known locations are a row
    per restaurant, which Spark broadcasts where their size allows; else a location with
    most of the orders is split by AQE.
    """
    known = restaurants.select("location_id").distinct().withColumn("known", F.lit(True))
    placed = orders.join(known, "location_id", "left")
    return _stack(
        [
            _keyed_checks(
                placed,
                "order_id",
                "duplicate_orders",
                missing_orders=_missing(orders),
                invalid_dates=F.col("order_date").isNull(),
                missing_customer_ids=F.col("customer_id").isNull(),
                cancelled_transactions=F.coalesce(F.col("status") == CANCELLED, F.lit(False)),
                invalid_location_refs=F.col("location_id").isNotNull() & F.col("known").isNull(),
            ),
            _keyed_checks(
                items,
                "order_line_id",
                "duplicate_order_lines",
                missing_items=_missing(items),
                negative_quantities=F.coalesce(F.col("quantity") < 0, F.lit(False)),
                missing_menu_ids=F.col("item_id").isNull(),
            ),
            _checks(
                menu,
                missing_menu=_total(_missing(menu)),
                invalid_menu_prices=F.count_if((F.col("base_price") <= 0) | (F.col("cost") <= 0)),
            ),
            _checks(customers, missing_customers=_total(_missing(customers))),
            _checks(
                ratings, invalid_ratings=F.count_if((F.col("rating") < 1) | (F.col("rating") > 5))
            ),
            _checks(wastage, impossible_wastage=F.count_if(F.col("quantity") > max_wastage)),
        ]
    )


def _one_per_order(orders: DataFrame) -> DataFrame:
    """One row per order id with its copy count.

    Repeated ids are found on the ids alone. Only their rows are compared: the copy that
    sorts first by date and then by the other columns stays. It is a minimum and not a
    window, so copies of a hot id shrink on the map side. All other rows stay as they are.
    """
    rest = [c for c in orders.columns if c not in ("order_id", "order_date")]
    ids = orders.groupBy(F.col("order_id").alias("_id")).agg(F.count("*").alias("copies"))
    repeated = ids.filter(F.col("copies") > 1)
    same = F.col("order_id").eqNullSafe(F.col("_id"))
    single = orders.join(repeated, same, "left_anti").withColumn("copies", F.lit(1).cast("bigint"))
    first = F.min(F.struct("order_date", *rest))
    folded = (
        orders.join(repeated, same, "left_semi")
        .groupBy("order_id")
        .agg(first.alias("kept"), F.count("*").alias("copies"))
        .select("order_id", "kept.*", "copies")
    )
    return single.unionByName(folded)


def clean_orders(orders: DataFrame) -> DataFrame:
    """Drop repeated order ids, then orders that are not completed or not paid."""
    return (
        _one_per_order(orders)
        .filter((F.col("status") == COMPLETED) & (F.col("total_amount") > 0))
        .select(*orders.columns)
    )


def cleaning_log(orders: DataFrame) -> DataFrame:
    """Rows removed by each cleaning step, ``(step, removed)``."""
    done = F.coalesce(F.col("status") == COMPLETED, F.lit(False))
    paid = F.coalesce(F.col("total_amount") > 0, F.lit(False))
    row = _one_per_order(orders).agg(
        _total(F.col("copies") - 1).alias("duplicates"),
        F.count_if(~done).alias("cancelled"),
        F.count_if(done & ~paid).alias("invalid amounts"),
    )
    return one_row_to_rows(row, "step", "removed")
