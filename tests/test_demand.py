from datetime import date, datetime, timedelta

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from tavola.operators import classifier, demand
from tavola.sources.checkpoints import materialize

START = date(2024, 1, 1)


def daily(spark, values, skip=()):
    rows = [(START + timedelta(days=n), v) for n, v in enumerate(values) if n not in skip]
    return spark.createDataFrame(rows, "order_date date, demand long")


def test_daily_demand_takes_any_quantity_of_completed_orders(make):
    orders = make(
        "orders",
        [("O1", "C", "L", datetime(2024, 1, 5, 9), "App", 0.0, "Completed"),
         ("O2", "C", "L", datetime(2024, 1, 5, 23), "App", 1.0, "Completed"),
         ("O3", "C", "L", datetime(2024, 1, 5), "App", 1.0, "Cancelled")],
    )
    items = make("order_items", [("1", "O1", "A", 5, 1.0, 1.0), ("2", "O1", "A", -1, 1.0, 1.0),
                                 ("3", "O2", "A", 2, 1.0, 1.0), ("4", "O3", "A", 9, 1.0, 1.0)])
    assert [tuple(r) for r in demand.daily_demand(items, orders).collect()] == [(date(2024, 1, 5), 6)]


def test_lags_count_rows_not_days(spark):
    rows = demand.demand_features(daily(spark, range(10), skip=(8,))).collect()
    assert [(r["order_date"].day, r["lag_1"], r["lag_7"]) for r in rows] == [(8, 6, 0), (10, 7, 1)]
    assert (rows[0]["dayofweek"], rows[0]["month"], rows[0]["dayofyear"]) == (2, 1, 8)
    other = demand.demand_features_dom(daily(spark, range(8))).first()
    assert (other["dayofweek"], other["day"]) == (0, 8)


def test_split_keeps_the_order_of_dates(spark):
    rows = demand.demand_split(demand.demand_features(daily(spark, range(18)))).collect()
    train = [r["order_date"] for r in rows if r["split"] == "train"]
    test = [r["order_date"] for r in rows if r["split"] == "test"]
    assert (len(train), len(test)) == (8, 3)
    assert max(train) < min(test)


def test_split_equals_limit_and_subtract(spark):
    features = demand.demand_features(daily(spark, [n * n for n in range(30)]))
    split = demand.demand_split(features)
    first = features.orderBy("order_date").limit(int(features.count() * 0.8))
    rest = sorted(map(tuple, features.subtract(first).collect()))
    marked = split.filter("split = 'test'").drop("split").collect()
    assert sorted(map(tuple, marked)) == rest


def test_error_leaves_days_without_demand_out_of_mape(spark):
    df = spark.createDataFrame([(0, 5.0), (10, 8.0), (20, 21.0)], "demand long, predicted double")
    assert tuple(demand.forecast_error(df).first()) == (12.5, 2.67)


def test_forecast_models(spark):
    values = [100 + 10 * (n % 7) + n % 3 for n in range(120)]
    models, predictions = demand.train_forecast(demand.demand_features(daily(spark, values)))
    metrics = {r["model"]: r for r in demand.forecast_metrics(predictions).collect()}
    assert set(metrics) == {"LinearRegression", "RandomForest", "GBT"} == set(models)
    assert all(m["rmse"] >= m["mae"] >= 0 and m["r2"] <= 1 for m in metrics.values())
    best = min(metrics.values(), key=lambda m: (m["rmse"], m["model"]))
    assert [m["model"] for m in metrics.values() if m["best"]] == [best["model"]]
    assert demand.best_forecast(models, predictions)[0] == best["model"]


def test_metrics_agree_with_the_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    values = [50 + (n * 37) % 11 for n in range(60)]
    only = {"LinearRegression": LinearRegression(labelCol="demand")}
    _, predictions = demand.train_forecast(demand.demand_features(daily(spark, values)), models=only)
    row = demand.forecast_metrics(predictions).first()
    scorer = RegressionEvaluator(labelCol="demand", predictionCol="predicted")
    for name in ("rmse", "mae", "r2"):
        assert row[name] == pytest.approx(scorer.setMetricName(name).evaluate(predictions))


def test_day_of_month_forecast(spark):
    features = demand.demand_features_dom(daily(spark, [10 + n % 7 for n in range(60)]))
    found = demand.forecast_day_of_month(features, trees=5)
    assert found.columns == ["date", "demand", "predicted"]
    assert found.count() == 11


def test_classifier_scores(spark):
    rows = [
        (str(n), "Profit Driver" if n % 2 else "Low Performer", 10 + n % 2 * 90, 20.0 + n % 2 * 40, float(n), 1.0 + n % 5)
        for n in range(120)
    ]
    df = spark.createDataFrame(
        rows, "item_id string, performance_class string, qty_sold long, profit_pct double, revenue double, cost double"
    )
    models, table = classifier.train_menu_classifier(df)
    found = {r["model"]: r for r in table.collect()}
    assert set(found) == {"RandomForest", "DecisionTree", "LogisticRegression"} == set(models)
    for row in found.values():
        assert all(0 <= row[m] <= 1 for m in ("accuracy", "f1", "precision", "recall"))
        assert row["training_records"] + row["test_records"] == 120
    assert found["DecisionTree"]["accuracy"] == 1.0
    assert [name for name, row in found.items() if row["best"]] == ["DecisionTree"]
    version = classifier.model_version(table).first()
    assert (version["best_model"], version["accuracy"]) == ("DecisionTree", 1.0)


def test_checkpoint_folder_of_the_session_is_kept(spark):
    materialize(spark.range(3))
    folder = spark.sparkContext.getCheckpointDir()
    materialize(spark.range(3))
    assert spark.sparkContext.getCheckpointDir() == folder


def test_least_squares_is_that_of_the_library(spark):
    values = [100 + 10 * (n % 7) + (n * 37) % 23 + n // 10 for n in range(200)]
    features = demand.demand_features(daily(spark, values))
    names = list(demand.YEAR_FEATURES)
    found = demand.least_squares(features, names, "demand")
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(features)
    model = LinearRegression(labelCol="demand", solver="normal").fit(rows)
    assert [found[n] for n in names] == pytest.approx(list(model.coefficients), abs=1e-6)
    assert found["intercept"] == pytest.approx(model.intercept, abs=1e-6)
    test = demand.linear_forecast(features)
    only = {"LinearRegression": LinearRegression(labelCol="demand", solver="normal")}
    _, expected = demand.train_forecast(features, models=only)
    pairs = test.join(expected.withColumnRenamed("predicted", "other"), "order_date").collect()
    assert len(pairs) == test.count() > 30
    assert all(r["predicted"] == pytest.approx(r["other"], abs=1e-6) for r in pairs)


def test_least_squares_of_dependent_and_constant_features(spark):
    df = spark.createDataFrame([(n, 2 * n, 5, 3.0 * n + 1) for n in range(10)], "a int, b int, c int, y double")
    found = demand.least_squares(df, ["a", "b", "c"], "y")
    assert found["a"] + 2 * found["b"] == pytest.approx(3) and found["c"] == 0
    assert found["intercept"] == pytest.approx(1)
    with pytest.raises(ValueError):
        demand.least_squares(df.limit(0), ["a"], "y")


def test_scores_are_those_of_the_evaluator(spark):
    rows = [("m", float(n % 4), float((n * n) % 5 % 4)) for n in range(100)] + [("n", 0.0, 3.0), ("n", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "model string, label double, prediction double")
    found = {r["model"]: r for r in classifier.classification_scores(df).collect()}
    names = {"accuracy": "accuracy", "f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}
    for model in "mn":
        for ours, theirs in names.items():
            expected = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df.filter(df.model == model))
            assert found[model][ours] == pytest.approx(expected, abs=5e-5)
