from datetime import datetime

from pyspark.sql import functions as F

from tavola.operators import locations, profit

DAY = datetime(2024, 1, 5, 12)


def order(oid, amount=100.0, status="Completed", location="L1", customer="C1", channel="App"):
    return (oid, customer, location, DAY, channel, amount, status)


def line(oid, item, qty, total, lid=None):
    return (lid or f"{oid}-{item}", oid, item, qty, total / qty if qty else 0.0, total)


def dish(item, cost, category="Mains"):
    return (item, f"name {item}", category, cost, cost * 2, True)


def test_profitability_filters_and_rounds(make, by_key):
    orders = make(
        "orders",
        [order("O1"), order("O2", status="Cancelled"), order("O3", amount=0.0), order("O4")],
    )
    items = make(
        "order_items",
        [
            line("O1", "A", 2, 20.0),
            line("O1", "A", 1, 10.0, "again"),
            line("O4", "A", 1, 10.01),
            line("O1", "B", 0, 5.0),
            line("O1", "B", -1, 5.0, "returned"),
            line("O2", "A", 9, 90.0),
            line("O3", "A", 9, 90.0),
            line("O1", "Free", 3, 0.0),
            line("O1", "Unknown", 1, 7.0),
        ],
    )
    menu = make("menu_items", [dish("A", 4.0), dish("B", 1.0), dish("Free", 1.5)])
    found = by_key(profit.menu_profitability(items, orders, menu), "item_id")
    assert set(found) == {"A", "Free"}
    assert found["A"] == {
        "item_id": "A",
        "item_name": "name A",
        "category": "Mains",
        "cost": 4.0,
        "base_price": 8.0,
        "qty_sold": 4,
        "revenue": 40.01,
        "order_count": 3,
        "total_cost": 16.0,
        "profit": 24.01,
        "profit_pct": 60.01,
    }
    assert found["Free"]["profit"] == -4.5
    assert found["Free"]["profit_pct"] == 0.0


def test_profitability_arithmetic_on_known_item(make, by_key):
    orders = make("orders", [order("O1")])
    items = make("order_items", [line("O1", "A", 17490, 5285994.84)])
    menu = make("menu_items", [dish("A", 125.51)])
    row = by_key(profit.menu_profitability(items, orders, menu), "item_id")["A"]
    assert (row["total_cost"], row["profit"], row["profit_pct"]) == (2195169.90, 3090824.94, 58.47)


def quadrant_input(spark, rows):
    return spark.createDataFrame(rows, "item_id string, qty_sold long, profit_pct double").select(
        "*", F.lit(1).alias("order_count")
    )


def test_quadrants_and_the_exactly_average_item(spark, by_key):
    rows = [("a", 30, 70.0), ("b", 30, 10.0), ("c", 10, 70.0), ("d", 10, 10.0), ("e", 20, 40.0)]
    found = by_key(profit.classify_quadrant(quadrant_input(spark, rows)), "item_id")
    assert {k: v["performance_class"] for k, v in found.items()} == {
        "a": "Profit Driver",
        "b": "Volume Driver",
        "c": "Hidden Opportunity",
        "d": "Low Performer",
        "e": "Profit Driver",
    }


def test_equal_items_are_all_average(spark):
    """Adding 0.1 three times as a double would put the mean above 0.1."""
    rows = [(name, 3, 0.1) for name in "abc"]
    found = profit.classify_quadrant(quadrant_input(spark, rows)).collect()
    assert {r["performance_class"] for r in found} == {"Profit Driver"}


def test_location_quadrants_use_their_own_average(make):
    orders = make("orders", [order("O1", location="L1"), order("O2", location="L2")])
    items = make(
        "order_items",
        [
            line("O1", "A", 10, 100.0),
            line("O1", "B", 2, 4.0),
            line("O2", "A", 1, 10.0),
            line("O2", "B", 20, 40.0),
        ],
    )
    menu = make("menu_items", [dish("A", 2.0), dish("B", 1.0)])
    rows = profit.location_menu_classified(items, orders, menu).collect()
    found = {(r["location_id"], r["item_id"]): r["loc_class"] for r in rows}
    assert found == {
        ("L1", "A"): "Profit Driver",
        ("L1", "B"): "Low Performer",
        ("L2", "A"): "Hidden Opportunity",
        ("L2", "B"): "Volume Driver",
    }


def test_top_profit_breaks_ties_by_id(spark):
    rows = [(f"i{n}", "x", 1, 1.0, 5.0, 1.0, "c") for n in (3, 1, 2)]
    df = spark.createDataFrame(
        rows,
        "item_id string, item_name string, qty_sold long, revenue double, profit double, "
        "profit_pct double, performance_class string",
    )
    assert [r["item_id"] for r in profit.top_profit_items(df, 2).collect()] == ["i1", "i2"]


def test_location_comparison_distinct_customers_and_zero_revenue(make, by_key):
    orders = make(
        "orders",
        [
            order("O1", 100.0, customer="C1"),
            order("O2", 50.0, customer="C1"),
            order("O3", 0.0, location="L2", customer="C2"),
            order("O4", 70.0, status="Cancelled"),
        ],
    )
    items = make("order_items", [line("O1", "A", 2, 90.0), line("O4", "A", 5, 70.0)])
    menu = make("menu_items", [dish("A", 10.0)])
    wasted = make("wastage", [("W1", "A", "L1", 3, 30.5, DAY.date(), "Expired")])
    found = by_key(locations.location_comparison(orders, items, menu, wasted), "location_id")
    assert found["L1"] == {
        "location_id": "L1",
        "revenue": 150.0,
        "total_orders": 2,
        "avg_order_value": 75.0,
        "unique_customers": 1,
        "gross_revenue": 90.0,
        "total_cost": 20.0,
        "profit": 70.0,
        "total_wasted_qty": 3,
        "wastage_cost": 30.5,
        "profit_margin_pct": 46.67,
    }
    assert found["L2"]["profit"] == 0.0
    assert found["L2"]["profit_margin_pct"] is None
