"""One scan of the orders for all results that sum or count them.

Two tables are stored once and merged into every coarser result:

* the cube, a row per day, hour, location and channel, with counts and exact sums;
* bitmaps of customers, a row per location, channel and 32,768 customer numbers. Two of them
  are merged by OR, so customers are counted exactly over any set of locations and channels
  without moving an id again. At finer grain a bitmap would be nearly empty and larger than
  the ids in it, so the calendar is not a part of this table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from tavola.functions.columns import day, exact_sum, in_cents, season, weekend_flag
from tavola.functions.filters import completed
from tavola.functions.fixed import COMPLETED
from tavola.sources.checkpoints import materialize


def sales_cube(orders: DataFrame) -> DataFrame:
    """Completed orders per ``day``, ``hour``, ``location_id`` (where orders have one) and
    ``channel``: ``done_orders`` rows, ``order_ids``, ``amounts`` that are known and their
    exact sum, and the same of orders with a positive amount, as ``paid_...``."""
    amount = F.col("total_amount")
    is_paid = amount > 0
    keys = [day("order_date").alias("day"), F.hour("order_date").alias("hour")]
    if "location_id" in orders.columns:
        keys.append(F.col("location_id"))
    return (
        completed(orders)
        .groupBy(*keys, "channel")
        .agg(
            F.count("*").alias("done_rows"),
            F.count("order_id").alias("done_orders"),
            F.count("total_amount").alias("done_amounts"),
            exact_sum("total_amount").alias("done_sum"),
            F.count(F.when(is_paid, F.lit(1))).alias("paid_rows"),
            F.count(F.when(is_paid, F.col("order_id"))).alias("paid_orders"),
            exact_sum(F.when(is_paid, amount)).alias("paid_sum"),
        )
    )


def dense_numbers(df: DataFrame, key: str) -> DataFrame:
    """``(key, number)``: the distinct keys numbered from 0 without gaps, in their order.

    Keys are numbered inside the partitions of a sort; a partition's first number comes from
    the sizes of those before it, one row for each partition.
    """
    ordered = materialize(
        df.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(key)
        .withColumn("at", F.monotonically_increasing_id())
    )
    lane, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    lanes = ordered.groupBy(lane.alias("lane")).agg(F.count("*").alias("n"))
    lower = Window.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    before = lanes.select("lane", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("before"))
    return (
        ordered.withColumn("lane", lane)
        .join(F.broadcast(before), "lane")
        .select(key, (F.col("before") + place).cast("bigint").alias("number"))
    )


def visits(orders: DataFrame) -> DataFrame:
    """The known customers of completed orders per ``location_id`` and ``channel``, one row
    each, and whether they paid (``is_paid``)."""
    located = F.col("location_id") if "location_id" in orders.columns else F.lit(None).cast("string")
    is_paid = F.coalesce(F.col("total_amount") > 0, F.lit(False))
    return (
        completed(orders)
        .filter(F.col("customer_id").isNotNull())
        .groupBy(located.alias("location_id"), "channel", "customer_id")
        .agg(F.max(is_paid).alias("is_paid"))
    )


def customer_bitmaps(visited: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """``(location_id, channel, bucket, done_bits, paid_bits)`` of the customers of
    :func:`visits`, of completed and of paid orders.

    Integral customer ids are taken as their numbers; other ids need ``numbers``
    (:func:`dense_numbers`). Rows are dealt by location, channel and bucket before bits are set:
    a partial bitmap of every task would be larger than the ids. A channel with most of the
    customers is dealt over its buckets.
    """
    if numbers is None:
        if not isinstance(visited.schema["customer_id"].dataType, IntegralType):
            raise ValueError("customer ids that are no integers need dense_numbers")
        number = F.col("customer_id").cast("bigint")
    else:
        visited, number = visited.join(numbers, "customer_id"), F.col("number")
    bit = F.bitmap_bit_position(number)
    dealt = visited.select(
        "location_id",
        "channel",
        F.bitmap_bucket_number(number).alias("bucket"),
        bit.alias("bit"),
        F.when(F.col("is_paid"), bit).alias("paid_bit"),
    ).repartition("location_id", "channel", "bucket")
    return dealt.groupBy("location_id", "channel", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("done_bits"),
        F.bitmap_construct_agg("paid_bit").alias("paid_bits"),
    )


def unique_customers(bitmaps: DataFrame, *keys: str, bits: str = "paid_bits") -> DataFrame:
    """Distinct customers per ``keys``; keys whose customers are all unknown have no row."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg(bits).alias("bits"))
    counted = merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("unique_customers"))
    return counted.withColumn("unique_customers", F.coalesce("unique_customers", F.lit(0)).cast("bigint"))


def _with_customers(figures: DataFrame, bitmaps: DataFrame, key: str, bits: str) -> DataFrame:
    customers = unique_customers(bitmaps, key, bits=bits).withColumnRenamed(key, "of_key")
    known = figures.join(customers, F.col(key).eqNullSafe(F.col("of_key")), "left").drop("of_key")
    return known.withColumn("unique_customers", F.coalesce("unique_customers", F.lit(0)))


def channel_analysis_of(cube: DataFrame, bitmaps: DataFrame) -> DataFrame:
    figures = (
        cube.groupBy("channel")
        .agg(
            F.sum("paid_rows").alias("rows"),
            F.sum("paid_orders").alias("total_orders"),
            F.sum("paid_sum").alias("total"),
        )
        .filter(F.col("rows") > 0)
        .select(
            "channel",
            "total_orders",
            in_cents(F.col("total")).alias("revenue"),
            F.round(F.try_divide(F.col("total").cast("double"), F.col("rows")), 2).alias("avg_order_value"),
        )
    )
    return _with_customers(figures, bitmaps, "channel", "paid_bits")


def location_takings_of(cube: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The part of the location comparison that comes from orders."""
    figures = cube.groupBy("location_id").agg(
        in_cents(F.sum("done_sum")).alias("revenue"),
        F.sum("done_orders").alias("total_orders"),
        F.try_divide(F.sum("done_sum").cast("double"), F.sum("done_amounts")).alias("avg_order_value"),
    )
    return _with_customers(figures, bitmaps, "location_id", "done_bits")


def _by_period(cube: DataFrame, count_name: str, *keys: Column) -> DataFrame:
    return (
        cube.groupBy(*keys)
        .agg(
            F.sum("paid_rows").alias("rows"),
            F.sum("paid_orders").alias(count_name),
            in_cents(F.sum("paid_sum")).alias("revenue"),
        )
        .filter(F.col("rows") > 0)
        .drop("rows")
    )


def _year(by_year: bool) -> list[Column]:
    return [F.year("day").alias("year")] if by_year else []


def peak_hours_of(cube: DataFrame) -> DataFrame:
    return _by_period(cube, "order_count", F.col("hour")).orderBy(F.desc("order_count"), "hour")


def peak_days_of(cube: DataFrame) -> DataFrame:
    days = _by_period(cube, "order_count", F.dayofweek("day").alias("dow"))
    return days.orderBy(F.desc("order_count"), "dow")


def weekend_analysis_of(cube: DataFrame) -> DataFrame:
    return _by_period(cube, "orders", weekend_flag("day").alias("is_weekend"))


def monthly_analysis_of(cube: DataFrame, by_year: bool = False) -> DataFrame:
    return _by_period(cube, "orders", *_year(by_year), F.month("day").alias("month"))


def seasonal_analysis_of(cube: DataFrame, by_year: bool = False) -> DataFrame:
    return _by_period(cube, "orders", *_year(by_year), season("day").alias("season"))


def paid_totals_of(cube: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The headline figures of paid orders, as ``(metric, value)``."""
    customers = unique_customers(bitmaps).select("unique_customers").scalar()
    row = cube.agg(
        in_cents(F.sum("paid_sum")).alias("total_revenue"),
        F.coalesce(F.sum("paid_rows"), F.lit(0)).cast("double").alias("total_orders"),
        F.coalesce(customers, F.lit(0)).cast("double").alias("unique_customers"),
        F.try_divide(F.sum("paid_sum").cast("double"), F.sum("paid_rows")).alias("avg_order_value"),
    )
    return row.unpivot([], list(row.columns), "metric", "value")
