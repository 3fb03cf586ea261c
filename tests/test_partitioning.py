"""Model results do not depend on the session's number of shuffle partitions."""

import pytest

import compare
from tavola.functions.columns import money_sum, six_digit_avg
from tavola.operators import classifier, customers, profit, segments
from tavola.sources.star import StarTables

FOLDER = f"{compare.DATA}/sf0.001"


@pytest.fixture()
def at_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def run(n, make):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        return sorted(map(tuple, make().collect()), key=str)

    yield run
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_segments(spark, at_partitions):
    def make():
        rfm = customers.rfm(StarTables(spark, FOLDER).orders())
        return segments.segment_counts(segments.label_segments(segments.kmeans_segments(rfm)))

    assert at_partitions(1, make) == at_partitions(7, make)


def test_clusters_in_many_parts_are_equal_at_any_number_of_partitions(spark, at_partitions):
    """1,000 customers in more than 8 parts: who is with whom does not depend on the session."""

    def make():
        rfm = customers.rfm(StarTables(spark, FOLDER).orders())
        scored = segments.fit_segments(rfm, starts=1, rows_per_part=8)[1]
        assert scored.rdd.getNumPartitions() > 8
        return scored.select("customer_id", "prediction")

    first = at_partitions(1, make)
    assert first and first == at_partitions(7, make) == at_partitions(64, make)


def test_model_comparison(spark, at_partitions):
    def make():
        t = StarTables(spark, FOLDER)
        items = profit.menu_classified(t.order_items(), t.orders(), t.menu_items())
        return classifier.train_menu_classifier(items)[1]

    assert at_partitions(1, make) == at_partitions(7, make)


def test_money_is_rounded_after_the_sum(spark):
    cases = {4.0: [0.004] * 1000, 0.25: [0.125, 0.125], 0.3: [0.1, 0.2], -1.5: [-0.5, -1.0]}
    for total, values in cases.items():
        rows = spark.createDataFrame([(v,) for v in values], "x double")
        assert rows.agg(money_sum("x")).first()[0] == total
    assert spark.createDataFrame([(None,)], "x double").agg(money_sum("x")).first()[0] is None
    assert spark.createDataFrame([(1e-3,), (2e-3,)], "x double").agg(six_digit_avg("x")).first()[0] == 0.0015


def test_unknown_margin_is_a_low_performer(spark):
    rows = spark.createDataFrame(
        [(1, 10, 50.0, 3), (2, 30, None, 3), (3, 30, 60.0, 3), (4, 1, 70.0, 3)],
        "item_id long, qty_sold long, profit_pct double, order_count long",
    )
    got = {r["item_id"]: r["performance_class"] for r in profit.classify_quadrant(rows).collect()}
    assert got == {1: "Low Performer", 2: "Low Performer", 3: "Profit Driver", 4: "Hidden Opportunity"}


def test_orders_without_a_known_customer_stay(spark, tmp_path):
    import pyarrow.parquet as pq
    import pyarrow as pa

    from tavola.operators import quality

    orders = pq.read_table(f"{FOLDER}/orders.parquet")
    keys = orders.column("o_custkey").to_pylist()
    keys[:15] = [None] * 15
    keys[15:20] = [10**9] * 5
    at = orders.schema.get_field_index("o_custkey")
    pq.write_table(orders.set_column(at, "o_custkey", pa.array(keys, orders.schema.field(at).type)), tmp_path / "orders.parquet")
    for name in ("customer", "lineitem", "part", "events", "supplier", "nation", "region"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{FOLDER}/{name}.parquet")
    t = StarTables(spark, str(tmp_path))
    located = t.located_orders()
    assert located.count() == len(keys)
    report = quality.quality_report(
        located, t.order_items(), t.menu_items(), t.customers(), t.ratings(), t.wastage(), t.restaurants()
    )
    checks = {r["check"]: r["violations"] for r in report.collect()}
    assert checks["missing_customer_ids"] == 15
    assert checks["missing_orders"] == 15 + 20


def test_one_scan_for_recency(spark):
    """The latest date comes from the shuffle of the customers."""
    t = StarTables(spark, FOLDER)
    for frame in (customers.rfm(t.orders()), customers.churn_risk(t.orders())):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan or plan.count("Scan parquet") == 1
