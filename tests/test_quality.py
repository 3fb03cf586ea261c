from datetime import datetime

import pytest

from tavola.operators import quality

DAY = datetime(2024, 1, 5, 12)


@pytest.fixture(scope="module")
def dirty(make):
    return {
        "orders": make(
            "orders",
            [
                ("O1", "C1", "L1", DAY, "App", 10.0, "Completed"),
                ("O1", "C1", "L1", DAY, "App", 20.0, "Completed"),
                ("O2", "C2", "L9", DAY, "App", 5.0, "Cancelled"),
                ("O2", "C2", "L9", DAY, "App", 5.0, "Cancelled"),
                ("O2", "C2", "L9", DAY, "App", 6.0, "Cancelled"),
                ("O3", None, None, None, "App", 0.0, "Completed"),
                ("O4", "C3", "L1", DAY, "App", 1.0, None),
            ],
        ),
        "items": make(
            "order_items",
            [
                ("1", "O1", "A", 0, 1.0, 1.0),
                ("1", "O1", None, -1, 1.0, 1.0),
                ("2", "O1", "A", 2, None, 1.0),
            ],
        ),
        "menu": make(
            "menu_items",
            [("A", "a", "x", 0.0, 1.0, True), ("B", "b", "x", 1.0, -1.0, True), ("C", "c", "x", None, 1.0, True)],
        ),
        "customers": make("customers", [("C1", "n", None, "p", "c", DAY.date(), "App")]),
        "ratings": make(
            "ratings", [(str(n), "O1", "C1", "A", n, DAY.date()) for n in (0, 1, 5, 6, None)]
        ),
        "wastage": make(
            "wastage",
            [("W1", "A", "L1", 1000, 1.0, DAY.date(), "x"), ("W2", "A", "L1", 1001, 1.0, DAY.date(), "x")],
        ),
        "restaurants": make("restaurants", [("L1", "one", "city", True)]),
    }


def test_quality_report_counts(dirty):
    rows = quality.quality_report(**dirty).collect()
    assert {r["check"]: r["violations"] for r in rows} == {
        "missing_orders": 4,
        "missing_items": 2,
        "missing_menu": 1,
        "missing_customers": 1,
        "duplicate_orders": 2,
        "duplicate_order_lines": 1,
        "invalid_menu_prices": 2,
        "negative_quantities": 1,
        "invalid_dates": 1,
        "invalid_ratings": 2,
        "missing_customer_ids": 1,
        "missing_menu_ids": 1,
        "invalid_location_refs": 3,
        "impossible_wastage": 1,
        "cancelled_transactions": 3,
    }


def test_quality_report_of_empty_tables_is_zero(dirty):
    empty = {name: df.limit(0) for name, df in dirty.items()}
    assert {r["violations"] for r in quality.quality_report(**empty).collect()} == {0}


def test_null_profile(dirty, by_key):
    found = by_key(quality.null_profile(dirty["orders"]), "column")
    assert found["customer_id"] == {"column": "customer_id", "nulls": 1, "pct": 14.29}
    assert found["order_id"]["nulls"] == 0
    empty = by_key(quality.null_profile(dirty["orders"].limit(0)), "column")
    assert empty["status"] == {"column": "status", "nulls": 0, "pct": 0.0}


def test_missing_total(dirty):
    assert quality.missing_total(dirty["orders"]).first()["missing"] == 4


def test_clean_orders_keeps_the_first_copy(dirty):
    rows = quality.clean_orders(dirty["orders"]).collect()
    assert [(r["order_id"], r["total_amount"]) for r in rows] == [("O1", 10.0)]


def test_cleaning_log_follows_the_steps(dirty):
    rows = quality.cleaning_log(dirty["orders"]).collect()
    assert {r["step"]: r["removed"] for r in rows} == {
        "duplicates": 3,
        "cancelled": 2,
        "invalid amounts": 1,
    }


def test_quality_report_scans_each_table_once(spark, dirty, tmp_path):
    stored = {}
    for name, df in dirty.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    report = quality.quality_report(**stored)
    expected = {tuple(r) for r in quality.quality_report(**dirty).collect()}
    assert {tuple(r) for r in report.collect()} == expected
    final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == len(stored)
