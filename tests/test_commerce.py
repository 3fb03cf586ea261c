"""Wastage, ratings, promotions, prices, stock, channels, periods and figures."""

from datetime import date, datetime, timedelta
from random import Random

import pytest

from tavola.functions.filters import filter_menu, filter_orders
from tavola.operators import (
    anomalies,
    channels,
    inventory,
    kpis,
    periods,
    pricing,
    promotions,
    ratings,
    recommend,
    wastage,
)

DAY = datetime(2024, 1, 5, 12)


def order(oid, when=DAY, amount=100.0, status="Completed", customer="C1", channel="App", place="L1"):
    return (oid, customer, place, when, channel, amount, status)


def line(oid, item, qty, total=10.0, unit=5.0, lid="1"):
    return (lid, oid, item, qty, unit, total)


def dish(item, cost=1.0, category="Mains"):
    return (item, f"name {item}", category, cost, cost * 2, True)


def waste(item, qty, cost=1.0, when=DAY.date(), reason="Expired", place="L1"):
    return ("W", item, place, qty, cost, when, reason)


def score(item, value, oid="O1"):
    return ("R", oid, "C1", item, value, DAY.date())


def test_wastage_of_every_item(make, by_key):
    menu = make("menu_items", [dish("A"), dish("B")])
    items = make("order_items", [line("O1", "A", 5), line("O2", "A", 7), line("O1", "A", -2)])
    orders = make("orders", [order("O1", amount=0.0), order("O2", status="Cancelled")])
    found = by_key(
        wastage.wastage_by_item(make("wastage", [waste("A", 4, 2.5)]), menu, items, orders), "item_id"
    )
    assert (found["A"]["total_sold"], found["A"]["wastage_pct"]) == (3, 50.0)
    assert found["B"]["total_wastage_cost"] == 0.0
    assert found["B"]["wastage_pct"] == 0.0
    headline = wastage.wastage_headline(
        wastage.wastage_by_item(make("wastage", [waste("A", 4, 2.5)]), menu, items, orders)
    ).first()
    assert (headline["total_wastage_cost"], headline["high_wastage_items"]) == (2.5, 1)


@pytest.mark.parametrize(
    ("wasted", "sold", "ratio", "level"),
    [
        (3482, 18209, 16.05, "High"),
        (15, 84, 15.0, "Medium"),
        (1501, 8498, 15.01, "High"),
        (8, 91, 8.0, "Low"),
        (801, 9198, 8.01, "Medium"),
    ],
)
def test_wastage_risk_bands(make, wasted, sold, ratio, level):
    items = make("order_items", [line("O1", "A", sold), line("O1", "A", -5)])
    row = wastage.wastage_risk(make("wastage", [waste("A", wasted)]), items).first()
    assert (row["waste_ratio"], row["risk_level"]) == (ratio, level)


def test_wastage_risk_of_item_never_sold(make):
    row = wastage.wastage_risk(
        make("wastage", [waste("A", 3)]), make("order_items", [line("O1", "B", 1)])
    ).first()
    assert (row["total_sold"], row["waste_ratio"]) == (0, 75.0)


def test_wastage_dimensions(make, by_key):
    rows = [
        waste("A", 1, 1.1, date(2024, 1, 7), "Expired", "L1"),
        waste("B", 2, 2.2, date(2024, 1, 6), "Damaged", "L2"),
        waste("Z", 4, 4.4, date(2024, 1, 6), "Damaged", "L2"),
    ]
    df = make("wastage", rows)
    menu = make("menu_items", [dish("A"), dish("B", category="Drinks")])
    assert by_key(wastage.wastage_by_category(df, menu), "category")["Drinks"]["total_qty"] == 2
    assert by_key(wastage.wastage_by_day(df), "dow")[7]["total_cost"] == 6.6
    assert by_key(wastage.wastage_by_reason(df), "reason")["Damaged"]["total_qty"] == 6
    assert [r["location_id"] for r in wastage.wastage_by_location(df).collect()] == ["L2", "L1"]


def test_ratings(make, by_key):
    rows = [score("A", 5), score("A", 4), score("A", 2), score("B", None), score("A", 3, "O9")]
    df = make("ratings", rows)
    found = by_key(ratings.rating_analysis(df), "item_id")
    assert found["A"]["avg_rating"] == 3.5
    assert (found["A"]["positive_ratings"], found["A"]["negative_ratings"]) == (2, 1)
    assert found["A"]["satisfaction_pct"] == 50.0
    assert (found["B"]["total_ratings"], found["B"]["satisfaction_pct"]) == (0, None)
    places = by_key(ratings.rating_by_location(df, make("orders", [order("O1")])), "location_id")
    assert places[None]["avg_rating"] == 3.0
    assert places["L1"]["total_ratings"] == 3


def test_best_and_worst_rated_need_enough_ratings(make):
    rows = [score("often", 4)] * 11 + [score("seldom", 5)] * 10 + [score("poor", 1)] * 11
    df = make("ratings", rows)
    assert [r["item_id"] for r in ratings.best_rated(df).collect()] == ["often", "poor"]
    assert [r["item_id"] for r in ratings.worst_rated(df).collect()] == ["poor", "often"]


def test_rating_anomalies_ignore_single_ratings(make):
    rows = [score("one", 5)] + [score("same", 4)] * 3 + [score("mixed", 1), score("mixed", 5)] * 2
    found = anomalies.rating_anomalies(make("ratings", rows), min_count=0, max_std=0.5).collect()
    assert [(r["item_id"], r["rating_std"]) for r in found] == [("same", 0.0)]


def test_promotions(make, by_key):
    menu = make("menu_items", [dish("A", 2.0), dish("B", 3.0)])
    items = make("order_items", [line("O1", "A", 3, 10.0), line("O1", "B", 1, 5.0), line("O2", "A", 9)])
    orders = make("orders", [order("O1"), order("O2", status="Cancelled")])
    promos = make("promotions", [("P1", "A", 10, DAY.date(), DAY.date())] * 2)
    on = promotions.promotion_performance(items, orders, menu, promos).collect()
    off = promotions.nonpromoted_performance(items, orders, menu, promos).collect()
    assert [tuple(r) for r in on] == [("A", 3, 10.0, 4.0)]
    assert [tuple(r) for r in off] == [("B", 1, 5.0, 2.0)]
    performance = promotions.promotion_performance(items, orders, menu, promos)
    assert promotions.promo_traps(performance, min_qty=2, max_margin=0.5).count() == 1
    assert promotions.promo_traps(performance, min_qty=3, max_margin=0.5).count() == 0
    assert promotions.promo_traps(performance, min_qty=2, max_margin=0.4).count() == 0
    share = by_key(promotions.promotion_dependency(items, promos), "item_id")
    assert share["A"]["promo_dependency_pct"] == 100.0
    assert (share["B"]["promo_qty"], share["B"]["promo_dependency_pct"]) == (0, 0.0)


def test_promo_trap_without_revenue_is_not_an_error(spark):
    df = spark.createDataFrame(
        [("A", 9, 0.0, -3.0)], "item_id string, qty_sold long, revenue double, total_profit double"
    )
    assert promotions.promo_traps(df, 1).count() == 0


def test_overlapping_promotions_count_a_line_once(make, by_key):
    orders = make("orders", [order("O1", datetime(2024, 1, 5, 23)), order("O2", datetime(2024, 1, 9))])
    items = make("order_items", [line("O1", "A", 2), line("O2", "A", 6), line("O9", "A", 2)])
    promos = make(
        "promotions",
        [
            ("P1", "A", 10, date(2024, 1, 1), date(2024, 1, 5)),
            ("P2", "A", 10, date(2024, 1, 4), date(2024, 1, 6)),
            ("P3", "A", 10, date(2024, 1, 9), date(2024, 1, 8)),
        ],
    )
    found = by_key(promotions.promotion_dependency_in_window(items, orders, promos), "item_id")
    assert found["A"] == {
        "item_id": "A",
        "total_qty": 10,
        "promo_qty": 2,
        "promo_dependency_pct": 20.0,
    }


def test_promotion_windows_against_brute_force(spark, make, by_key):
    """Random windows with gaps, overlaps, nesting and one of ten years, which is one row."""
    rng = Random(4)
    start = date(2015, 1, 1)
    windows = []
    for n in range(60):
        begin = start + timedelta(days=rng.randrange(3000))
        windows.append((f"P{n}", rng.choice("ABC"), 10, begin, begin + timedelta(days=rng.randrange(-3, 90))))
    windows.append(("P", "D", 10, start, start + timedelta(days=3652)))
    windows.append(("Q", "D", 10, start + timedelta(days=10), start + timedelta(days=12)))
    days = [start + timedelta(days=rng.randrange(-50, 3800)) for _ in range(300)]
    orders = make("orders", [order(f"O{n}", datetime(d.year, d.month, d.day, n % 24)) for n, d in enumerate(days)])
    sold = [(n, rng.choice("ABCDE"), rng.randrange(1, 5)) for n in range(300) for _ in range(2)]
    items = make("order_items", [line(f"O{n}", i, q) for n, i, q in sold])
    found = by_key(promotions.promotion_dependency_in_window(items, orders, make("promotions", windows)), "item_id")
    assert set(found) == set("ABCDE")
    for item, row in found.items():
        runs = [(a, b) for _, i, _, a, b in windows if i == item]
        assert row["total_qty"] == sum(q for _, i, q in sold if i == item)
        assert row["promo_qty"] == sum(q for n, i, q in sold if i == item and any(a <= days[n] <= b for a, b in runs))


def test_promotion_rows_follow_their_number_and_not_their_days(make):
    promos = make("promotions", [("P", "A", 10, date(2010, 1, 1), date(2019, 12, 31))])
    orders = make("orders", [order("O1", datetime(2015, 1, 5))])
    items = make("order_items", [line("O1", "A", 2)])
    text = promotions.promotion_dependency_in_window(items, orders, promos)._jdf.queryExecution().toString()
    assert "Generate" not in text and "explode" not in text


def test_price_sensitivity_bands(make, by_key):
    items = make(
        "order_items",
        [line("O1", "A", 1, unit=110.01), line("O1", "B", 1, unit=110.0), line("O1", "C", 1, unit=105.0), line("O1", "D", 1, unit=99.0)],
    )
    history = make(
        "pricing_history",
        [(f"P{n}", item, 1.0, price, DAY.date()) for n, (item, price) in enumerate(
            [("A", 90.0), ("A", 110.0), ("B", 100.0), ("C", 100.0)])],
    )
    found = by_key(pricing.price_sensitivity(items, history), "item_id")
    assert {k: v["sensitivity_class"] for k, v in found.items()} == {
        "A": "Highly Price Sensitive",
        "B": "Moderately Price Sensitive",
        "C": "Low Price Sensitivity",
        "D": "Low Price Sensitivity",
    }
    assert found["A"]["num_price_changes"] == 2
    assert (found["D"]["avg_price"], found["D"]["price_variation_pct"]) == (0.0, 0.0)


def test_price_what_if_limits(spark):
    df = spark.createDataFrame(
        [("A", "a", 10.0, 3)], "item_id string, item_name string, base_price double, qty_sold long"
    )
    assert pricing.price_what_if(df, -50).first()["new_price"] == 5.0
    with pytest.raises(ValueError):
        pricing.price_what_if(df, 51)


def test_stock_advice_at_the_edges(make, by_key):
    rows = [("I", "L1", item, stock, 10) for item, stock in (("a", 9), ("b", 10), ("c", 14), ("d", 15))]
    found = by_key(inventory.inventory_recommendations(make("inventory", rows)), "item_id")
    assert [found[k]["recommendation"] for k in "abcd"] == [
        "REORDER NOW",
        "MONITOR",
        "MONITOR",
        "SUFFICIENT",
    ]


def test_slow_movers(make):
    items = make("order_items", [line("O1", "A", 10), line("O1", "B", 4), line("O1", "C", 4), line("O1", "Z", 1)])
    menu = make("menu_items", [dish("A"), dish("B"), dish("C")])
    assert [r["item_id"] for r in inventory.slow_moving_threshold(items, menu, 0.9).collect()] == ["B", "C"]
    # The cut comes before the names, so the unnamed item takes a place.
    assert [r["item_id"] for r in inventory.slow_moving_bottom_k(items, menu, 2).collect()] == ["B"]
    assert [r["item_id"] for r in inventory.low_sellers(items, 2).collect()] == ["Z", "B"]
    assert [r["item_id"] for r in inventory.top_sellers(items, 3).collect()] == ["A", "B", "C"]


def test_channels(make, by_key):
    orders = make(
        "orders",
        [order("O1"), order("O2", customer="C2"), order("O3", status="Cancelled"), order("O4", channel="Web", amount=0.0)],
    )
    items = make("order_items", [line("O1", "A", 2, 10.0), line("O1", "B", 3, 5.0), line("O2", "A", 1, 6.0)])
    summary = by_key(channels.channel_analysis(orders), "channel")
    assert summary == {
        "App": {"channel": "App", "total_orders": 2, "revenue": 200.0, "avg_order_value": 100.0, "unique_customers": 2}
    }
    lines = channels.channel_detailed(items, orders).first()
    assert (lines["total_qty"], lines["total_orders"], lines["unique_items"]) == (6, 3, 2)
    assert (lines["avg_line_value"], lines["avg_basket_size"]) == (7.0, 2.0)
    assert channels.channel_detailed(items, orders, distinct_orders=True).first()["avg_basket_size"] == 3.0


def test_periods(make, by_key):
    days = [datetime(2024, 1, 5, 10), datetime(2024, 1, 6, 10), datetime(2024, 1, 7, 22), datetime(2023, 12, 1, 10),
            datetime(2024, 2, 1, 10), datetime(2024, 3, 1, 10), datetime(2024, 11, 1, 10)]
    df = make("orders", [order(f"O{n}", when) for n, when in enumerate(days)])
    assert by_key(periods.peak_hours(df), "hour")[22]["order_count"] == 1
    assert periods.peak_hours(df).first()["hour"] == 10
    assert by_key(periods.weekend_analysis(df), "is_weekend")[1]["orders"] == 2
    seasons = by_key(periods.seasonal_analysis(df), "season")
    assert {k: v["orders"] for k, v in seasons.items()} == {"Winter": 5, "Spring": 1, "Fall": 1}
    assert by_key(periods.monthly_analysis(df), "month")[1]["revenue"] == 300.0
    assert periods.monthly_analysis(df, by_year=True).filter("year = 2023 and month = 12").count() == 1


def test_filters_are_inclusive_and_none_means_all(make):
    days = [datetime(2024, 1, 4, 23, 59), datetime(2024, 1, 5), datetime(2024, 1, 6, 23, 59), datetime(2024, 1, 7)]
    df = make("orders", [order(f"O{n}", when, channel="App" if n else "Web") for n, when in enumerate(days)])
    ids = [r["order_id"] for r in filter_orders(df, date(2024, 1, 5), date(2024, 1, 6)).collect()]
    assert ids == ["O1", "O2"]
    assert filter_orders(df).count() == 4
    assert filter_orders(df, location="L1", channel="Web").count() == 1


def test_menu_filter(spark):
    df = spark.createDataFrame([("x", "c"), ("y", "d")], "performance_class string, category string")
    assert filter_menu(df, ["x"], ["c", "d"]).count() == 1
    assert filter_menu(df).count() == 2
    assert filter_menu(df, categories=["d"]).count() == 1


def test_figures(make):
    orders = make("orders", [order("O1", amount=10.1), order("O2", amount=20.2, customer="C2"), order("O3", status="Cancelled", amount=5.0)])
    rows = kpis.master_kpis(
        orders, make("menu_items", [dish("A")]), make("wastage", [waste("A", 1, 3.3)]), make("ratings", [score("A", 4), score("A", 5)])
    ).collect()
    assert {r["metric"]: r["value"] for r in rows} == {
        "total_revenue": 30.3,
        "total_orders": 2.0,
        "unique_customers": 2.0,
        "avg_order_value": 15.15,
        "total_menu_items": 1.0,
        "total_wastage_cost": 3.3,
        "avg_rating": 4.5,
    }
    everything = kpis.executive_kpis(orders).first()
    assert (everything["total_revenue"], everything["total_orders"]) == (35.3, 3)


def test_anomalies_of_equal_days_are_empty(make):
    rows = [order(f"O{n}", datetime(2024, 1, 1 + n)) for n in range(5)]
    assert anomalies.sales_anomalies(make("orders", rows), z=0.0).count() == 0


def test_anomaly_is_found_whatever_the_status(make):
    rows = [order(f"O{n}", datetime(2024, 1, 1 + n)) for n in range(20)]
    rows.append(order("O99", datetime(2024, 2, 1), amount=9000.0, status="Cancelled"))
    found = anomalies.sales_anomalies(make("orders", rows)).collect()
    assert [(r["order_date"], r["daily_revenue"]) for r in found] == [(date(2024, 2, 1), 9000.0)]


def classified(spark, rows):
    return spark.createDataFrame(
        [(i, c, p, q, 1.0, 1.0, 1.0) for i, c, p, q in rows],
        "item_id string, performance_class string, profit_pct double, qty_sold long, "
        "revenue double, total_cost double, profit double",
    )


def test_recommendation_rules(spark, by_key):
    rows = [
        ("promote", "Hidden Opportunity", 60.01, 1),
        ("hidden", "Hidden Opportunity", 60.0, 1),
        ("review", "Low Performer", 20.0, 1),
        ("remove", "Low Performer", 29.99, 1),
        ("low", "Low Performer", 30.0, 1),
        ("reprice", "Volume Driver", 39.99, 1),
        ("volume", "Volume Driver", 40.0, 1),
        ("maintain", "Profit Driver", 58.47, 17490),
    ]
    share = spark.createDataFrame(
        [("review", 15.01), ("remove", 15.0), ("maintain", 16.65)], "item_id string, wastage_pct double"
    )
    found = by_key(recommend.recommend(classified(spark, rows), share), "item_id")
    assert {k: v["recommendation"].split(" -")[0] for k, v in found.items()} == {
        "promote": "PROMOTE",
        "hidden": "MONITOR",
        "review": "REVIEW",
        "remove": "REMOVE or REDESIGN",
        "low": "MONITOR",
        "reprice": "REPRICE",
        "volume": "MONITOR",
        "maintain": "MAINTAIN",
    }
    best = found["maintain"]
    assert best["recommendation"] == "MAINTAIN - Strong performer"
    assert best["priority"] == "High"
    assert best["evidence"] == "Margin: 58.47% | Sold: 17490 | Wastage: 16.65%"
    assert found["low"]["evidence"] == "Margin: 30.0% | Sold: 1 | Wastage: 0.0%"


def test_priorities_sort_by_urgency(spark):
    rows = [(str(p), "Profit Driver", p, 1) for p in (45.0, 45.01, 55.0, 55.01, 65.0, 65.01)]
    found = recommend.by_priority(recommend.recommend(classified(spark, rows))).collect()
    assert [r["priority"] for r in found] == ["Critical", "High", "High", "Medium", "Medium", "Low"]


def test_tricky_cases_and_missing_ratings(spark, make):
    rows = [("A", "x", 39.0, 15001), ("B", "x", 61.0, 9999), ("C", "x", 50.0, 15001)]
    scores = make("ratings", [score("A", 5), score("B", 1)])
    counts = {r["case"]: r["n"] for r in recommend.tricky_cases(classified(spark, rows), scores).collect()}
    assert counts == {
        "high_selling_loss_making": 1,
        "low_selling_high_margin": 1,
        "highly_rated_low_profit": 1,
        "low_rated_high_sales": 1,
    }
    strict = recommend.tricky_cases(classified(spark, rows), scores, require_rating=True)
    assert {r["case"]: r["n"] for r in strict.collect()}["low_rated_high_sales"] == 0
