"""Classifiers that learn the quadrant label.

The label is a rule on two of the features, so high scores are expected: the
comparison checks the training chain and predicts nothing new.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tavola.sources.checkpoints import laid_out

FEATURES = ("qty_sold", "profit_pct", "revenue", "cost")


def classifiers(seed: int = 42) -> dict[str, Estimator]:
    return {
        "RandomForest": RandomForestClassifier(numTrees=50, seed=seed),
        "DecisionTree": DecisionTreeClassifier(maxDepth=5, seed=seed),
        "LogisticRegression": LogisticRegression(maxIter=20),
    }


def classification_scores(predictions: DataFrame) -> DataFrame:
    """``(model, accuracy, f1, precision, recall, best)`` of ``(model, label, prediction)`` rows.

    Precision, recall and F1 are weighted by the true size of the classes; four digits. The best
    is that with the highest F1, ties by name. Rows become counts per pair of classes first.
    """
    pairs = predictions.groupBy("model", "label", "prediction").agg(F.count("*").alias("n"))
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(none)
    as_label = F.struct(F.col("label").alias("cls"), F.col("n").alias("truly"), none.alias("said"), hit.alias("hits"))
    as_said = F.struct(F.col("prediction").alias("cls"), none.alias("truly"), F.col("n").alias("said"), none.alias("hits"))
    classes = (
        pairs.select("model", F.inline(F.array(as_label, as_said)))
        .groupBy("model", "cls")
        .agg(*(F.sum(c).alias(c) for c in ("truly", "said", "hits")))
        .withColumns(
            {
                "precision": F.coalesce(F.try_divide("hits", "said"), F.lit(0.0)),
                "recall": F.coalesce(F.try_divide("hits", "truly"), F.lit(0.0)),
            }
        )
    )
    both = F.col("precision") + F.col("recall")
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), both), F.lit(0.0))

    def weighted(x: Column) -> Column:
        return F.round(F.try_divide(F.sum(x * F.col("truly")), F.sum("truly")), 4)

    scores = classes.groupBy("model").agg(
        F.round(F.try_divide(F.sum("hits"), F.sum("truly")), 4).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(F.col("precision")).alias("precision"),
        weighted(F.col("recall")).alias("recall"),
    )
    # one row for each model
    rank = F.row_number().over(Window.orderBy(F.desc("f1"), "model"))
    return scores.withColumn("best", rank == 1)


def train_menu_classifier(
    classified: DataFrame, seed: int = 42, rows_per_part: int = 100_000
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit the three classifiers on 80 % of the items and score the others.

    Items are split by a hash of their id and laid out in parts of about ``rows_per_part``
    rows, so the models do not depend on the session's partitioning.

    Returns the models and ``(model, accuracy, f1, precision, recall,
    training_records, test_records, best)`` rows (:func:`classification_scores`).
    """
    spark = classified.sparkSession
    items = laid_out(
        classified.select("item_id", "performance_class", *FEATURES), "item_id", rows_per_part
    )
    indexer = StringIndexer(inputCol="performance_class", outputCol="label").fit(items)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fifth = F.pmod(F.xxhash64("item_id", F.lit(seed)), F.lit(5))
    train, test = items.filter(fifth < 4), items.filter(fifth == 4)
    models = {
        name: Pipeline(stages=[indexer, assembler, estimator]).fit(train)
        for name, estimator in classifiers(seed).items()
    }
    scored = [
        model.transform(test).select(F.lit(name).alias("model"), "label", "prediction")
        for name, model in models.items()
    ]
    scores = classification_scores(reduce(DataFrame.unionByName, scored))
    sizes = {"training_records": train.count(), "test_records": test.count()}
    return models, scores.withColumns({name: F.lit(n) for name, n in sizes.items()})


def model_version(comparison: DataFrame, version: str = "v1.0") -> DataFrame:
    """One row that records what was trained, on how much, and how well."""
    return comparison.filter("best").select(
        F.lit("menu_classifier").alias("model_name"),
        F.lit(version).alias("version"),
        F.current_timestamp().alias("trained_on"),
        F.array(*map(F.lit, classifiers())).alias("algorithms_compared"),
        F.col("model").alias("best_model"),
        "accuracy",
        F.col("f1").alias("f1_score"),
        F.array(*map(F.lit, FEATURES)).alias("features_used"),
        "training_records",
        "test_records",
    )
