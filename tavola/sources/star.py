"""The retail tables seen through a star schema of orders, line items and events.

Joins are only made where a column needs them: ``orders`` has no location, and
``located_orders`` takes it from the customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tavola.functions.fixed import CANCELLED, COMPLETED

# Wastage reasons by order key, dealt in this order.
REASONS = ("Expired", "Overproduction", "Damaged", "Customer Return", "Prep Error")


class StarTables:
    """Retail tables over ``<folder>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._schemas = {}

    def raw(self, name: str) -> DataFrame:
        path = f"{self._folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self._spark.read.parquet(path).schema
        return self._spark.read.schema(self._schemas[path]).parquet(path)

    def orders(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_orderpriority").alias("channel"),
            F.col("o_totalprice").alias("total_amount"),
            # Nested and null-safe, so that Spark folds a test of one status to a test
            # of the source column and pushes it to the scan.
            F.when(status.eqNullSafe("F"), COMPLETED)
            .otherwise(F.when(status.eqNullSafe("P"), CANCELLED).otherwise("Open"))
            .alias("status"),
        )

    def located_orders(self) -> DataFrame:
        homes = self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("location_id")
        )
        return (
            self.orders()
            .join(homes, "customer_id", "left")
            .select(
                "order_id",
                "customer_id",
                "location_id",
                "order_date",
                "channel",
                "total_amount",
                "status",
            )
        )

    def order_items(self) -> DataFrame:
        return self.raw("lineitem").select(
            self._line_id().alias("order_line_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
            F.col("l_extendedprice").alias("line_total"),
        )

    @staticmethod
    def _line_id():
        return F.col("l_orderkey") * 10 + F.col("l_linenumber")

    def menu_items(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("cost"),
            (F.col("p_retailprice") * 2).alias("base_price"),
            (F.col("p_size") <= 40).alias("is_available"),
        )

    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("home_location_id"),
            F.col("c_mktsegment").alias("preferred_channel"),
        )

    def restaurants(self) -> DataFrame:
        regions = self.raw("region").select(
            F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("city")
        )
        return (
            self.raw("nation")
            .join(regions, "n_regionkey")
            .select(
                F.col("n_nationkey").alias("location_id"),
                F.col("n_name").alias("location_name"),
                "city",
                F.lit(True).alias("is_active"),
            )
        )

    def _dealt(self, table: str, key: str):
        """The table of events has no order or item: they are dealt over all keys."""
        keys = self.raw(table).agg(F.max(key) + 1).scalar()
        return F.try_mod(F.col("event_id"), keys)

    def ratings(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("rating_id"),
            self._dealt("orders", "o_orderkey").alias("order_id"),
            F.col("user_id").alias("customer_id"),
            self._dealt("part", "p_partkey").alias("item_id"),
            (F.least(F.lit(4), F.floor(F.col("value") / 25)).cast("int") + 1).alias("rating"),
            F.col("ts").alias("rating_date"),
        )

    def event_orders(self) -> DataFrame:
        """Events as completed orders: the only table with a time of day."""
        return self.raw("events").select(
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("order_date"),
            F.col("event_type").alias("channel"),
            F.col("value").alias("total_amount"),
            F.lit(COMPLETED).alias("status"),
        )

    def _suppliers(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("location_id")
        )

    def _wasted(self) -> DataFrame:
        return self.raw("lineitem").filter(F.col("l_returnflag") == "R")

    def _wastage_columns(self) -> list:
        kind = F.col("l_orderkey") % len(REASONS) + 1
        return [
            self._line_id().alias("wastage_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").alias("cost"),
            F.col("l_shipdate").cast("date").alias("wastage_date"),
            F.element_at(F.array(*map(F.lit, REASONS)), kind.cast("int")).alias("reason"),
        ]

    def wastage(self) -> DataFrame:
        return self._wasted().select(*self._wastage_columns())

    def located_wastage(self) -> DataFrame:
        return (
            self._wasted()
            .join(self._suppliers(), "l_suppkey", "left")
            .select(*self._wastage_columns(), "location_id")
        )

    def pricing_history(self) -> DataFrame:
        """Price changes; the old price, which no analysis reads, is left out."""
        return (
            self.raw("lineitem")
            .filter(F.col("l_returnflag") == "N")
            .select(
                self._line_id().alias("price_id"),
                F.col("l_partkey").alias("item_id"),
                F.try_divide("l_extendedprice", "l_quantity").alias("new_price"),
                F.col("l_shipdate").cast("date").alias("change_date"),
            )
        )

    def promotions(self) -> DataFrame:
        start = F.col("l_shipdate").cast("date")
        return (
            self.raw("lineitem")
            .filter(F.col("l_discount") >= 0.10)
            .select(
                self._line_id().alias("promo_id"),
                F.col("l_partkey").alias("item_id"),
                F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
                start.alias("start_date"),
                F.date_add(start, 60).alias("end_date"),
            )
        )

    def inventory(self) -> DataFrame:
        """Open quantity per location and item. Lines are summed per supplier and item
        before they meet either table; unknown ones stay."""
        open_qty = F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0)
        sizes = self.raw("part").select(
            F.col("p_partkey").alias("item_id"), (F.col("p_size") + 20).alias("reorder_level")
        )
        return (
            self.raw("lineitem")
            .select("l_suppkey", F.col("l_partkey").alias("item_id"), open_qty.alias("open_qty"))
            .groupBy("l_suppkey", "item_id")
            .agg(F.sum("open_qty").alias("open_qty"))
            .join(self._suppliers(), "l_suppkey", "left")
            .groupBy("location_id", "item_id")
            .agg((F.sum("open_qty").cast("bigint") * 3).alias("stock_qty"))
            .join(sizes, "item_id", "left")
        )
