"""What the plans must look like for the work to spread over a cluster."""

import re

import pytest
from pyspark.sql import functions as F

import compare
from tavola.functions.filters import paid, sold_lines
from tavola.operators import customers, profit, sales_cube
from tavola.plans import catalog, oracle
from tavola.sources.star import StarTables

FOLDER = f"{compare.DATA}/sf0.001"
QUERIES, ORACLE = catalog.queries(), oracle.oracle_sql()
# These fit models while the frame is built, so only their results are checked.
EAGER = {"frequent_itemsets", "top_itemsets", "association_rules", "top_rules", "fitted_demand", "rule_segment_matching"}
# These rank clusters or models, of which there are a few: one row each in a window or a broadcast.
RANKED = {name for name in ORACLE if name.startswith("rule_")}
LAZY = sorted(set(ORACLE) - EAGER - RANKED)
BY_DATE = {"demand_features", "demand_features_dom", "demand_split", "forecast_error"}
# Windows along the days of one item, which are no more than the calendar has.
BY_DAY_OF_ITEM = {"promotion_dependency_in_window"}


@pytest.fixture
def no_broadcast(spark):
    """Plan as if every table were too large to send to all executors."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_joins_are_on_keys_and_nothing_leaves_the_jvm(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, FOLDER))
    unwanted = {
        "CartesianProduct", "NestedLoopJoin", "BroadcastHashJoin", "Python", "InPandas"
    }
    assert not [word for word in unwanted if word in text]
    if name not in BY_DATE | BY_DAY_OF_ITEM:
        assert not re.search(r"\bWindow\b", text)
    # A single partition only ever receives the one row of each partial aggregate.
    pattern = r"Exchange SinglePartition[^\n]*\n[^\n]*?\+- (\*\(\d+\) )?(\w+)"
    feeds = {match.group(2) for match in re.finditer(pattern, text)}
    allowed = {"HashAggregate", "SortAggregate"}
    if name in BY_DATE:
        allowed |= {"Project"}
    assert feeds <= allowed


def test_filters_and_columns_reach_the_scan(spark, make, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    make("orders", []).write.parquet(str(tmp_path / "orders"))
    make("order_items", []).write.parquet(str(tmp_path / "items"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    items = spark.read.parquet(str(tmp_path / "items"))
    text = paid(orders).select("order_id")._jdf.queryExecution().toString()
    assert "EqualTo(status,Completed)" in text and "GreaterThan(total_amount,0.0)" in text
    assert "ReadSchema: struct<order_id:string,total_amount:double,status:string>" in text
    text = sold_lines(items).select("item_id")._jdf.queryExecution().toString()
    assert "GreaterThan(quantity,0)" in text


def test_star_status_reaches_the_scan(spark):
    text = paid(StarTables(spark, FOLDER).orders())._jdf.queryExecution().toString()
    assert "EqualNullSafe(o_orderstatus,F)" in text


def test_the_cube_is_one_scan_of_the_orders(spark, make, tmp_path):
    """All calendar, channel and location results read the stored cube and bitmaps."""
    make("orders", []).write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    for frame in (sales_cube.sales_cube(orders), sales_cube.visits(orders)):
        assert plan(frame).count("FileScan") == 1 and plan(frame).count("Exchange hashpartitioning") == 1


def test_lines_are_shuffled_once_per_key_for_the_averages(spark, no_broadcast):
    """The subquery of the averages reuses the per-item shuffle of the result."""
    t = StarTables(spark, FOLDER)
    frame = profit.menu_classified(t.order_items(), t.orders(), t.menu_items())
    frame.collect()
    final = plan(frame)
    assert "ReusedExchange [item_id" in final


def test_lines_are_summed_before_the_orders_join(spark, no_broadcast):
    t = StarTables(spark, FOLDER)
    text = plan(customers.basket_size(t.order_items(), t.orders()))
    join = text.index("SortMergeJoin")
    assert "partial_sum(quantity" in text[join:]
    assert text.count("Exchange hashpartitioning") == 3


@pytest.mark.parametrize(
    "name",
    ["menu_classified", "location_comparison", "price_sensitivity", "churn_enhanced", "bundle_pairs",
     "sales_anomalies", "recommendations", "master_kpis"],
)
def test_results_do_not_depend_on_the_partitioning(spark, name):
    def rows(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            return sorted(map(repr, QUERIES[name](spark, FOLDER).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    assert rows(1) == rows(64)


def test_a_hot_order_item_and_customer(spark, make):
    """A third of the lines in one order of one item: totals stay whole."""
    base = spark.range(3000)
    hot = F.col("id") % 3 == 0
    items = base.select(
        F.col("id").cast("string").alias("order_line_id"),
        F.when(hot, "O0").otherwise(F.concat(F.lit("O"), F.col("id") % 50)).alias("order_id"),
        F.when(hot, "A").otherwise(F.concat(F.lit("I"), F.col("id") % 7)).alias("item_id"),
        F.lit(1).alias("quantity"),
        F.lit(2.5).alias("unit_price"),
        F.lit(2.5).alias("line_total"),
    )
    orders = spark.range(50).select(
        F.concat(F.lit("O"), F.col("id")).alias("order_id"),
        F.when(F.col("id") % 3 == 0, "C0").otherwise(F.concat(F.lit("C"), F.col("id"))).alias("customer_id"),
        F.lit("L1").alias("location_id"),
        F.lit("2024-01-05").cast("timestamp").alias("order_date"),
        F.lit("App").alias("channel"),
        F.lit(1.0).alias("total_amount"),
        F.lit("Completed").alias("status"),
    )
    menu = make("menu_items", [(i, i, "x", 1.0, 2.0, True) for i in ("A", *(f"I{n}" for n in range(7)))])
    found = profit.menu_profitability(items, orders, menu)
    assert found.agg(F.sum("qty_sold"), F.sum("revenue")).first()[:] == (3000, 7500.0)
    sizes = {r["customer_id"]: r["avg_basket_size"] for r in customers.basket_size(items, orders).collect()}
    assert sizes["C1"] == items.filter("order_id = 'O1'").count()
