"""Results of the cube equal those of the orders, and customers are counted exactly."""

from datetime import datetime, timedelta
from random import Random

import pytest

from tavola.operators import channels, kpis, locations, periods, sales_cube


@pytest.fixture(scope="module")
def orders(spark):
    rng = Random(3)
    rows = []
    for n in range(3000):
        rows.append((
            n if n % 97 else None,
            rng.choice([None, rng.randrange(50), rng.randrange(100_000)]),
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, datetime(2023, 1, 1) + timedelta(hours=rng.randrange(9000))]),
            rng.choice(["App", "Web", None]),
            rng.choice([None, 0.0, -1.0, rng.randrange(10_000) / 100]),
            rng.choice(["Completed", "Completed", "Cancelled", None]),
        ))
    rows += [(9001, 7, 9, datetime(2023, 5, 5), "Fax", 0.0, "Completed")]
    schema = (
        "order_id long, customer_id long, location_id int, order_date timestamp, channel string, "
        "total_amount double, status string"
    )
    return spark.createDataFrame(rows, schema)


def same(found, expected):
    names = expected.columns
    assert sorted(map(repr, found.select(*names).collect())) == sorted(map(repr, expected.collect()))


def test_calendar(orders):
    cube = sales_cube.sales_cube(orders)
    same(sales_cube.peak_hours_of(cube), periods.peak_hours(orders))
    same(sales_cube.peak_days_of(cube), periods.peak_days(orders))
    same(sales_cube.weekend_analysis_of(cube), periods.weekend_analysis(orders))
    for by_year in (False, True):
        same(sales_cube.monthly_analysis_of(cube, by_year), periods.monthly_analysis(orders, by_year))
        same(sales_cube.seasonal_analysis_of(cube, by_year), periods.seasonal_analysis(orders, by_year))


@pytest.mark.parametrize("numbered", [False, True])
def test_customers(spark, orders, numbered):
    if numbered:
        orders = orders.withColumn("customer_id", orders.customer_id.cast("string"))
    cube, visited = sales_cube.sales_cube(orders), sales_cube.visits(orders)
    if numbered:
        with pytest.raises(ValueError):
            sales_cube.customer_bitmaps(visited)
    numbers = sales_cube.dense_numbers(visited, "customer_id") if numbered else None
    bitmaps = sales_cube.customer_bitmaps(visited, numbers).persist()
    same(sales_cube.channel_analysis_of(cube, bitmaps), channels.channel_analysis(orders))
    same(sales_cube.paid_totals_of(cube, bitmaps), kpis.paid_totals(orders))
    lines = spark.createDataFrame([], "location_id int, item_id int, quantity int, line_total double, order_id long")
    menu = spark.createDataFrame([], "item_id int, cost double")
    waste = spark.createDataFrame([(None, 3, 2.0), (1, 4, 5.0)], "location_id int, quantity int, cost double")
    compared = locations.compare_takings(sales_cube.location_takings_of(cube, bitmaps), lines, menu, waste)
    same(compared, locations.location_comparison_of(orders, lines, menu, waste))
    assert {r["location_id"]: r["total_wasted_qty"] for r in compared.collect()} == {None: 3, 1: 4, 2: 0, 3: 0, 9: 0}


def test_dense_numbers_have_no_gaps(spark, orders):
    found = sales_cube.dense_numbers(orders.repartition(13), "customer_id").orderBy("customer_id").collect()
    ids = sorted({r["customer_id"] for r in orders.collect()} - {None})
    assert [tuple(r) for r in found] == [(c, n) for n, c in enumerate(ids)]


def test_empty(orders):
    none = orders.limit(0)
    cube, bitmaps = sales_cube.sales_cube(none), sales_cube.customer_bitmaps(sales_cube.visits(none))
    assert sales_cube.channel_analysis_of(cube, bitmaps).count() == 0
    same(sales_cube.paid_totals_of(cube, bitmaps), kpis.paid_totals(none))
