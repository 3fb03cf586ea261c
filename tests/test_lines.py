"""Results over the stored lines equal those over the two tables."""

import pytest

import compare
from tavola.functions.lines import completed_lines
from tavola.operators import (
    baskets,
    channels,
    customers,
    demand,
    locations,
    profit,
    promotions,
    wastage,
)
from tavola.sources.star import StarTables

BOTH = {
    "menu_profitability": (
        lambda t: profit.menu_profitability(t.order_items(), t.orders(), t.menu_items()),
        lambda t, lines: profit.menu_profitability_of(lines, t.menu_items()),
    ),
    "location_menu": (
        lambda t: profit.location_menu(t.order_items(), t.located_orders()),
        lambda t, lines: profit.location_menu_of(lines),
    ),
    "location_comparison": (
        lambda t: locations.location_comparison(
            t.located_orders(), t.order_items(), t.menu_items(), t.located_wastage()
        ),
        lambda t, lines: locations.location_comparison_of(
            t.located_orders(), lines, t.menu_items(), t.located_wastage()
        ),
    ),
    "channel_detailed": (
        lambda t: channels.channel_detailed(t.order_items(), t.orders(), True),
        lambda t, lines: channels.channel_detailed_of(lines, True),
    ),
    "category_diversity": (
        lambda t: customers.category_diversity(t.order_items(), t.orders(), t.menu_items()),
        lambda t, lines: customers.category_diversity_of(lines, t.menu_items()),
    ),
    "repeat_purchase_rate": (
        lambda t: customers.repeat_purchase_rate(t.order_items(), t.orders()),
        lambda t, lines: customers.repeat_purchase_rate_of(lines),
    ),
    "basket_size": (
        lambda t: customers.basket_size(t.order_items(), t.orders()),
        lambda t, lines: customers.basket_size_of(lines),
    ),
    "wastage_by_item": (
        lambda t: wastage.wastage_by_item(
            t.wastage(), t.menu_items(), t.order_items(), t.orders()
        ),
        lambda t, lines: wastage.wastage_by_item_of(t.wastage(), t.menu_items(), lines),
    ),
    "promotion_performance": (
        lambda t: promotions.promotion_performance(
            t.order_items(), t.orders(), t.menu_items(), t.promotions()
        ),
        lambda t, lines: promotions.promotion_performance_of(
            lines, t.menu_items(), t.promotions()
        ),
    ),
    "daily_demand": (
        lambda t: demand.daily_demand(t.order_items(), t.orders()),
        lambda t, lines: demand.daily_demand_of(lines),
    ),
    "baskets": (
        lambda t: baskets.baskets(t.order_items(), t.orders()),
        lambda t, lines: baskets.baskets_of(lines),
    ),
}


@pytest.fixture(scope="module")
def tables(spark):
    return StarTables(spark, f"{compare.DATA}/sf0.001")


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "completed_lines")
    completed_lines(tables.order_items(), tables.located_orders()).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(BOTH))
def test_same_result(tables, stored, name):
    joined, direct = BOTH[name]
    expected = joined(tables)
    found = direct(tables, stored).select(*expected.columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_stored_lines_are_shuffled_on_the_result_key_only(stored):
    text = customers.weekend_ratio_of(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text
    assert text.count("Exchange") == 1
