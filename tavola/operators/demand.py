"""Daily demand, its features, and forecasting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tavola.functions.columns import day
from tavola.functions.filters import completed
from tavola.sources.checkpoints import materialize

YEAR_FEATURES = ("dayofweek", "month", "dayofyear", "lag_1", "lag_7")
MONTH_FEATURES = ("dayofweek", "month", "day", "lag_1", "lag_7")


def daily_demand(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Quantity per order date, over completed orders.

    Lines are summed per order first, on the key the join shuffles by anyway.
    """
    per_order = items.groupBy("order_id").agg(F.sum("quantity").alias("quantity"))
    dated = completed(orders).select("order_id", day("order_date").alias("order_date"))
    return (
        per_order.join(dated, "order_id")
        .groupBy("order_date")
        .agg(F.sum("quantity").alias("demand"))
    )


def daily_demand_of(lines: DataFrame) -> DataFrame:
    dated = lines.groupBy(day("order_date").alias("order_date"))
    return dated.agg(F.sum("quantity").alias("demand"))


def _with_lags(daily: DataFrame) -> DataFrame:
    """Demand one and seven rows back. A row is a date, so the single window
    partition is bounded by the calendar and not by the number of orders."""
    by_date = Window.orderBy("order_date")
    return daily.withColumn("lag_1", F.lag("demand", 1).over(by_date)).withColumn(
        "lag_7", F.lag("demand", 7).over(by_date)
    )


def demand_features(daily: DataFrame) -> DataFrame:
    """Calendar features (Sunday = 1) and lags; rows without a full history drop."""
    return (
        _with_lags(daily)
        .withColumn("dayofweek", F.dayofweek("order_date"))
        .withColumn("month", F.month("order_date"))
        .withColumn("dayofyear", F.dayofyear("order_date"))
        .select("order_date", "demand", *YEAR_FEATURES)
        .dropna()
    )


def demand_features_dom(daily: DataFrame) -> DataFrame:
    """The same with day of month, and Monday = 0."""
    return (
        _with_lags(daily)
        .withColumn("dayofweek", F.weekday("order_date"))
        .withColumn("month", F.month("order_date"))
        .withColumn("day", F.dayofmonth("order_date"))
        .select("order_date", "demand", *MONTH_FEATURES)
        .dropna()
    )


def demand_split(features: DataFrame, frac: float = 0.8) -> DataFrame:
    """Mark the first ``frac`` of the dates as train and the rest as test."""
    cut = features.agg(F.floor(F.count("*") * frac)).scalar()
    position = F.row_number().over(Window.orderBy("order_date"))
    return (
        features.withColumn("position", position)
        .withColumn("split", F.when(F.col("position") <= cut, "train").otherwise("test"))
        .drop("position")
    )


def regressors(seed: int = 42) -> dict[str, Estimator]:
    return {
        "LinearRegression": LinearRegression(labelCol="demand"),
        "RandomForest": RandomForestRegressor(labelCol="demand", numTrees=50, seed=seed),
        "GBT": GBTRegressor(labelCol="demand", maxIter=20, seed=seed),
    }


def least_squares(rows: DataFrame, features: Sequence[str], label: str) -> dict[str, float]:
    """Coefficients by feature name, and the ``intercept``, of a linear least-squares fit.

    One aggregate gives the means and covariances; the equations of the features, which are
    as many as there are names, are solved on the driver. Features that depend on each other
    share their weight (the shortest solution).
    """
    names = [*features, label]
    pairs = [(x, y) for k, x in enumerate(names) for y in names[k:]]
    row = rows.dropna(subset=names).agg(
        *(F.avg(name).alias(f"mean {name}") for name in names),
        *(F.covar_pop(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"{x} {y}") for x, y in pairs),
    ).first()
    if row[f"mean {label}"] is None:
        raise ValueError("no rows to fit")

    def moment(x: str, y: str) -> float:
        return row[f"{x} {y}"] if (x, y) in pairs else row[f"{y} {x}"]

    sides = np.array([[moment(x, y) for y in features] for x in features])
    scale = np.sqrt(np.where(np.diag(sides) > 0, np.diag(sides), 1.0))
    right = np.array([moment(x, label) for x in features])
    slopes = np.linalg.lstsq(sides / np.outer(scale, scale), right / scale, rcond=1e-12)[0] / scale
    found = {name: float(slope) for name, slope in zip(features, slopes)}
    mean = row[f"mean {label}"] - sum(found[name] * row[f"mean {name}"] for name in features)
    return found | {"intercept": float(mean)}


def linear_prediction(coefficients: Mapping[str, float]) -> Column:
    """The value of a fit of :func:`least_squares`, as a column."""
    value = F.lit(coefficients["intercept"])
    for name, slope in coefficients.items():
        if name != "intercept":
            value = value + F.col(name) * F.lit(slope)
    return value


def linear_forecast(
    features: DataFrame, feature_cols: Sequence[str] = YEAR_FEATURES
) -> DataFrame:
    """``(order_date, demand, predicted)`` of the test dates, by a fit on the train dates."""
    rows = materialize(demand_split(features))
    fit = least_squares(rows.filter(F.col("split") == "train"), feature_cols, "demand")
    test = rows.filter(F.col("split") == "test")
    return test.select("order_date", "demand", linear_prediction(fit).alias("predicted"))


def fitted_demand(features: DataFrame, feature_cols: Sequence[str] = YEAR_FEATURES) -> DataFrame:
    """``(order_date, demand, fitted)`` of a fit on all dates, four digits."""
    fit = least_squares(features, feature_cols, "demand")
    return features.select("order_date", "demand", F.round(linear_prediction(fit), 4).alias("fitted"))


def train_forecast(
    features: DataFrame,
    feature_cols: Sequence[str] = YEAR_FEATURES,
    models: Mapping[str, Estimator] | None = None,
) -> tuple[dict[str, Model], DataFrame]:
    """Fit every model on the train dates and score the test dates.

    Returns the fitted models and ``(order_date, demand, predicted, model)`` rows.
    The features, one row per date, are materialised before the passes of the fits.
    """
    rows = VectorAssembler(inputCols=list(feature_cols), outputCol="features").transform(
        materialize(demand_split(features))
    )
    train = rows.filter(F.col("split") == "train")
    test = rows.filter(F.col("split") == "test")
    fitted = {name: model.fit(train) for name, model in (models or regressors()).items()}
    scored = [
        model.transform(test).select(
            "order_date",
            "demand",
            F.col("prediction").alias("predicted"),
            F.lit(name).alias("model"),
        )
        for name, model in fitted.items()
    ]
    predictions = scored[0]
    for more in scored[1:]:
        predictions = predictions.unionByName(more)
    return fitted, predictions


def forecast_metrics(predictions: DataFrame) -> DataFrame:
    """RMSE, MAE and R2 per model, the one with the least RMSE marked as best."""
    error = F.col("demand") - F.col("predicted")
    scores = predictions.groupBy("model").agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop("demand") * F.count("*"))).alias("r2"),
    )
    rank = F.row_number().over(Window.orderBy("rmse", "model"))
    return scores.withColumn("best", rank == 1)


def best_forecast(models: Mapping[str, Model], predictions: DataFrame) -> tuple[str, Model]:
    """The fitted model with the least RMSE, ties by name."""
    rmse = RegressionEvaluator(labelCol="demand", predictionCol="predicted", metricName="rmse")
    scores = {
        name: rmse.evaluate(predictions.filter(F.col("model") == name)) for name in sorted(models)
    }
    name = min(scores, key=scores.get)
    return name, models[name]


def forecast_day_of_month(features: DataFrame, trees: int = 100, seed: int = 42) -> DataFrame:
    """Test-date predictions of a random forest over the day-of-month features."""
    forest = {
        "RandomForest": RandomForestRegressor(labelCol="demand", numTrees=trees, seed=seed)
    }
    _, predictions = train_forecast(features, MONTH_FEATURES, forest)
    return predictions.select(F.col("order_date").alias("date"), "demand", "predicted")


def naive_forecast(features: DataFrame) -> DataFrame:
    """The demand of seven rows ago, taken as the forecast."""
    return features.select("order_date", "demand", F.col("lag_7").alias("predicted"))


def forecast_error(predictions: DataFrame) -> DataFrame:
    """MAPE over days with demand, MAE over all days, two digits."""
    error = F.abs(F.col("demand") - F.col("predicted"))
    relative = F.when(F.col("demand") != 0, F.try_divide(error, F.abs(F.col("demand"))))
    return predictions.agg(
        F.round(F.avg(relative) * 100, 2).alias("mape"), F.round(F.avg(error), 2).alias("mae")
    )
