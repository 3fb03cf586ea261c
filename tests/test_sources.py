"""CSV in, Parquet, CSV and JSON out, and the whole run over a small raw folder."""

import json
import os
from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from tavola.functions.lines import completed_lines
from tavola.operators import channels, periods
from tavola.plans import jobs
from tavola.sources import tables
from tavola.sources.bucketed import BucketedPair


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


ORDERS = """order_id,customer_id,location_id,order_date,channel,total_amount,status
O1,C1,L1,2024-05-05 13:20:00,App,10.5,Completed
O2,C1,L1,2024-13-45,App,20.5,Completed
O3,,L1,2024-05-06 09:00:00,App,many,Cancelled
"""


def test_bad_text_becomes_null_and_is_kept_as_a_reject(spark, tmp_path):
    raw = write(tmp_path / "raw" / "orders.csv", ORDERS)
    stored = str(tmp_path / "orders")
    tables.write_table(tables.read_table(spark, "orders", raw), stored)
    rows = {r["order_id"]: r for r in tables.read_table(spark, "orders", stored, "parquet").collect()}
    assert rows["O1"]["order_date"] == datetime(2024, 5, 5, 13, 20)
    assert rows["O2"]["order_date"] is None and rows["O2"]["total_amount"] == 20.5
    assert rows["O3"]["customer_id"] is None and rows["O3"]["total_amount"] is None
    assert "_corrupt_record" not in rows["O1"].asDict()
    rejects = tables.read_rejects(spark, stored).collect()
    assert sorted(r["order_id"] for r in rejects) == ["O2", "O3"]
    assert rejects[0]["_corrupt_record"].startswith("O")


def test_only_a_missing_path_is_tolerated(spark, tmp_path):
    assert tables.read_table(spark, "orders", str(tmp_path / "none.csv")) is None
    assert tables.read_table(spark, "orders", str(tmp_path / "none"), "parquet") is None
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        tables.read_table(spark, "orders", str(tmp_path / "empty"), "parquet")


def test_fallbacks(spark, tmp_path):
    csv = write(tmp_path / "restaurants.csv", "location_id,location_name,city,is_active\nL1,one,c,True\n")
    stored = str(tmp_path / "restaurants")
    assert tables.read_restaurants(spark, stored, str(tmp_path / "no.csv")) is None
    assert tables.read_restaurants(spark, stored, csv).first()["is_active"] is True
    assert os.path.exists(os.path.join(stored, "_SUCCESS"))
    assert tables.read_restaurants(spark, stored, str(tmp_path / "no.csv")).count() == 1
    found = tables.read_with_fallback(
        spark, [("restaurants", str(tmp_path / "no"), "parquet"), ("restaurants", csv, "csv")]
    )
    assert found.count() == 1

    analysis, risk = str(tmp_path / "wastage_analysis"), str(tmp_path / "wastage_risk")
    assert tables.read_wastage_share(spark, analysis, risk) is None
    tables.write_table(spark.createDataFrame([("A", 1.5)], "item_id string, waste_ratio double"), risk)
    assert tables.read_wastage_share(spark, analysis, risk).first()["wastage_pct"] == 1.5
    tables.write_table(spark.createDataFrame([("A", 2.5)], "item_id string, wastage_pct double"), analysis)
    assert tables.read_wastage_share(spark, analysis, risk).first()["wastage_pct"] == 2.5


def test_orders_are_stored_by_month_and_pruned(spark, make, tmp_path):
    rows = [
        (f"O{n}", "C", "L", datetime(2023 + n % 2, 1 + n % 3, 5), "App", float(n), "Completed")
        for n in range(30)
    ]
    path = str(tmp_path / "by_month")
    tables.write_partitioned_orders(make("orders", rows), path)
    assert sorted(p for p in os.listdir(path) if p.startswith("month")) == ["month=1", "month=2", "month=3"]
    january = spark.read.parquet(path).filter("month = 1")
    assert january.count() == periods.orders_with_month(make("orders", rows)).filter("month = 1").count()
    assert "PartitionFilters: [isnotnull(month" in january._jdf.queryExecution().toString()


def test_a_failed_rerun_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    broken = spark.range(10).select(F.when(F.col("id") > 7, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.write_table(broken, path)
    assert spark.read.parquet(path).count() == 5
    assert os.listdir(tmp_path) == ["t"]
    # a table may be rewritten from itself
    tables.write_table(spark.read.parquet(path).filter("id > 2"), path)
    assert spark.read.parquet(path).count() == 2 and os.listdir(tmp_path) == ["t"]


def test_a_switch_that_stopped_half_way_is_read(spark, tmp_path):
    path = tmp_path / "t"
    tables.write_table(spark.range(5), str(path))
    path.rename(tmp_path / "t.old")
    assert tables.read_table(spark, "orders", str(path), "parquet").count() == 5
    tables.write_table(spark.range(3), str(path))
    assert tables.read_table(spark, "orders", str(path), "parquet").count() == 3


def test_one_month_is_rewritten_alone(spark, make, tmp_path):
    def orders(months, amount):
        return make("orders", [(f"O{m}", "C", "L", datetime(2024, m, 5), "App", amount, "Completed") for m in months])

    path = str(tmp_path / "by_month")
    tables.write_partitioned_orders(orders((1, 2, 3), 1.0), path)
    before = {m: sorted(os.listdir(f"{path}/month={m}")) for m in (1, 2, 3)}
    tables.replace_months(orders((2,), 9.0), path)
    after = {m: sorted(os.listdir(f"{path}/month={m}")) for m in (1, 2, 3)}
    assert after[1] == before[1] and after[3] == before[3] and after[2] != before[2]
    found = spark.read.parquet(path).orderBy("month").collect()
    assert [(r["month"], r["total_amount"]) for r in found] == [(1, 1.0), (2, 9.0), (3, 1.0)]


def _bucketed_rows(spark, hot):
    lines = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("O"), F.col("id") % 400)).alias("order_id"),
        F.col("id").alias("item_id"),
        F.lit(1).alias("quantity"),
    )
    orders = spark.range(500).select(
        F.when(F.col("id") == 499, F.lit(None)).otherwise(F.concat(F.lit("O"), F.col("id"))).alias("order_id"),
        F.concat(F.lit("C"), F.col("id") % 9).alias("customer_id"),
    )
    return lines, orders


@pytest.mark.parametrize("hot", ["O7", None, "nobody's"])
def test_bucketed_join_is_the_join(spark, tmp_path, hot):
    lines, orders = _bucketed_rows(spark, hot)
    pair = BucketedPair(spark, str(tmp_path / "pair"), "order_id", 4)
    pair.store(lines, orders)
    expected = sorted(map(tuple, lines.join(orders, "order_id").select("order_id", "item_id", "customer_id").collect()))
    found = pair.joined(["item_id"], ["customer_id"])
    assert sorted(map(tuple, found.collect())) == expected
    # a session that did not store them
    for part in ("facts", "details"):
        spark.sql(f"DROP TABLE {pair._table(part)}")
    again = BucketedPair(spark, str(tmp_path / "pair"), "order_id", 4).joined(["item_id"], ["customer_id"])
    assert sorted(map(tuple, again.collect())) == expected
    assert pair.large_keys().count() == (1 if hot else 0) <= 4 / 0.25


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    lines, orders = _bucketed_rows(spark, "O7")
    pair = BucketedPair(spark, str(tmp_path / "pair"), "order_id", 4)
    pair.store(lines, orders)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = pair.joined(["item_id"], ["customer_id"])
        text = frame._jdf.queryExecution().executedPlan().toString()
        final = text.split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in final and "Exchange hashpartitioning" not in final
        assert "Bucketed: true" in final
        frame.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_csv_report_flattens_arrays(spark, tmp_path):
    df = spark.createDataFrame([(["a", "b"], 1.5)], "antecedent array<string>, lift double")
    tables.export_csv_report(df.coalesce(1), str(tmp_path / "rules"))
    (part,) = [p for p in os.listdir(tmp_path / "rules") if p.endswith(".csv")]
    assert (tmp_path / "rules" / part).read_text().splitlines() == ["antecedent,lift", '"a,b",1.5']


def raw_folder(root, orders=400):
    """A small chain: four dishes, two places, eight weeks, two orders a customer."""
    rng = Random(42)
    dishes = [("I1", "Mains", 4.0, 10.0), ("I2", "Mains", 9.0, 10.0), ("I3", "Drinks", 1.0, 4.0), ("I4", "Drinks", 3.5, 4.0)]
    start = datetime(2024, 1, 1, 10)
    text = {name: [] for name in ("orders", "order_items", "ratings", "wastage")}
    for n in range(orders):
        when = start + timedelta(days=n % 56, hours=n % 12)
        total = 0.0
        for at, (item, _, _, price) in enumerate(rng.sample(dishes, rng.randint(1, 4))):
            qty = rng.randint(1, 3)
            total += qty * price
            text["order_items"].append(f"{n}-{at},O{n},{item},{qty},{price},{qty * price}")
        status = "Cancelled" if n % 20 == 0 else "Completed"
        text["orders"].append(f"O{n},C{n % 50},L{n % 2},{when},{('App', 'Dine-in')[n % 2]},{total},{status}")
        text["ratings"].append(f"R{n},O{n},C{n % 50},I{n % 4 + 1},{n % 5 + 1},{when.date()}")
        text["wastage"].append(f"W{n},I{n % 4 + 1},L{n % 2},{n % 7},{n % 7 * 1.5},{when.date()},Expired")
    text["menu_items"] = [f"{i},dish {i},{c},{cost},{price},True" for i, c, cost, price in dishes]
    text["restaurants"] = ["L0,zero,city,True", "L1,one,city,True"]
    text["customers"] = [f"C{n},n{n},e,p,city,2023-01-01,App" for n in range(50)]
    text["pricing_history"] = [f"P{n},I{n + 1},1.0,{p},2024-01-01" for n, (_, _, _, p) in enumerate(dishes)]
    text["promotions"] = ["P1,I1,10,2024-01-01,2024-01-20"]
    text["inventory"] = [f"S{n},L0,I{n + 1},{10 * n},12" for n in range(4)]
    from tavola.sources.schemas import schema_of

    for name, lines in text.items():
        write(root / f"{name}.csv", "\n".join([",".join(schema_of(name).names), *lines]) + "\n")
    return str(root)


def read_json(folder):
    parts = [p for p in os.listdir(folder) if p.endswith(".json")]
    return [json.loads(row) for p in parts for row in open(os.path.join(folder, p))]


def test_the_whole_run(spark, tmp_path):
    raw = raw_folder(tmp_path / "raw")
    results, reports = str(tmp_path / "results"), str(tmp_path / "reports")
    jobs.run_all(spark, raw, str(tmp_path / "tables"), results, reports, buckets=4)

    assert sorted(os.listdir(reports)) == sorted(jobs.REPORTS.values())
    figures = {r["metric"]: r["value"] for r in read_json(f"{results}/metrics/master_kpis")}
    assert figures["total_orders"] == 380.0 and figures["unique_customers"] == 50.0
    log = {r["step"]: r["removed"] for r in read_json(f"{results}/metrics/cleaning_log")}
    assert log == {"duplicates": 0, "cancelled": 20, "invalid amounts": 0}
    classes = {r["performance_class"]: r["items"] for r in read_json(f"{results}/metrics/class_summary")}
    assert sum(classes.values()) == 4
    advice = spark.read.parquet(f"{results}/recommendations")
    share = spark.read.parquet(f"{results}/wastage_analysis")
    joined = advice.join(share.select("item_id", share.wastage_pct.alias("own")), "item_id")
    assert joined.filter("wastage_pct <> own").count() == 0 and joined.count() == 4
    (agreement,) = read_json(f"{results}/metrics/segment_agreement")
    assert agreement["total"] == 50
    (matching,) = read_json(f"{results}/metrics/segment_matching")
    assert matching["total"] == 50 and matching["matches"] >= agreement["matches"]
    orders = tables.read_table(spark, "orders", str(tmp_path / "tables" / "orders"), "parquet")
    lines = tables.read_table(spark, "order_items", str(tmp_path / "tables" / "order_items"), "parquet")
    assert spark.read.parquet(f"{results}/completed_lines").count() == completed_lines(lines, orders).count()
    for name, direct in (("peak_days", periods.peak_days), ("channel_analysis", channels.channel_analysis)):
        found, expected = spark.read.parquet(f"{results}/{name}"), direct(orders)
        assert sorted(map(tuple, found.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    assert spark.read.parquet(f"{results}/bundle_recommendations").count() == 6
    (version,) = read_json(f"{results}/metrics/model_version")
    assert version["training_records"] + version["test_records"] == 4
    models = {r["model"]: r for r in read_json(f"{results}/metrics/forecast_models")}
    assert sum(m["best"] for m in models.values()) == 1
    if models["LinearRegression"]["best"]:
        LinearRegressionModel.load(f"{results}/models/demand_forecast")
    # A second run replaces the results.
    assert jobs.export_reports(jobs.Workspace(spark, str(tmp_path / "tables"), results), reports)
