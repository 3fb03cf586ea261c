"""Customer segments by k-means, labelled by how much they spend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tavola.functions.columns import as_column, cents, money_avg
from tavola.functions.fixed import SEGMENT_LABELS, SEGMENT_STRATEGIES
from tavola.sources.checkpoints import laid_out

MEASURES = ("recency", "frequency", "monetary")


def fit_segments(
    rfm: DataFrame, k: int = 5, seed: int = 42, starts: int = 3, rows_per_part: int = 100_000
) -> tuple[PipelineModel, DataFrame]:
    """Standardise R, F and M and cluster them; returns the model and scored rows.

    The best of ``starts`` seeds by cost. Customers are laid out by their id in parts of about
    ``rows_per_part``, so that the clusters do not depend on the session's partitioning.

    The customers are materialised once, because the scaler, every k-means pass
    and the scoring would each compute the aggregation again.
    """
    customers = laid_out(
        rfm.select("customer_id", *MEASURES).fillna(0, subset=list(MEASURES)),
        "customer_id",
        rows_per_part,
    )
    stages = [
        VectorAssembler(inputCols=list(MEASURES), outputCol="measures"),
        StandardScaler(inputCol="measures", outputCol="features", withMean=True, withStd=True),
    ]
    scaling = Pipeline(stages=stages).fit(customers)
    scaled = scaling.transform(customers)
    fits = [
        KMeans(featuresCol="features", k=k, seed=seed + start).fit(scaled) for start in range(starts)
    ]
    best = min(fits, key=lambda fit: fit.summary.trainingCost)
    model = PipelineModel(stages=[*scaling.stages, best])
    return model, best.transform(scaled).drop("measures")


def kmeans_segments(rfm: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    _, scored = fit_segments(rfm, k, seed)
    return scored.select("customer_id", *MEASURES, "prediction")


def silhouette(
    scored: DataFrame, measures: Sequence[str] = MEASURES, cluster: str = "prediction"
) -> DataFrame:
    """Mean silhouette over squared distances of the standardised ``measures``, as one
    ``(metric, value)`` row, six digits.

    The mean distance from a row to a cluster follows from the cluster's size, its sum of
    values and its sum of squares, so one aggregate of a row per cluster serves all rows. A row
    that is alone in its cluster, or that has no other cluster, counts as 0.
    """
    scale = scored.agg(
        *(F.struct(F.avg(m).alias("mean"), F.stddev_samp(m).alias("std")).alias(m) for m in measures)
    )

    def standard(m: str) -> Column:
        std = scale.select(F.col(f"{m}.std")).scalar()
        centred = F.col(m) - scale.select(F.col(f"{m}.mean")).scalar()
        return F.coalesce(F.try_divide(centred, std), F.lit(0.0))

    names = [f"z{k}" for k in range(len(measures))]
    points = scored.select(
        F.col(cluster).alias("cluster"), *(standard(m).alias(z) for z, m in zip(names, measures))
    )
    norm = sum((F.col(z) * F.col(z) for z in names), F.lit(0.0))
    moments = points.groupBy("cluster").agg(
        F.count("*").alias("n"),
        F.sum(norm).alias("squares"),
        *(F.sum(z).alias(z) for z in names),
    )
    all_moments = moments.agg(F.collect_list(F.struct("cluster", "n", "squares", *names))).scalar()
    points, clusters = points.withColumn("clusters", all_moments), F.col("clusters")

    def distance(c: Column) -> Column:
        product = sum((F.col(z) * c[z] for z in names), F.lit(0.0))
        return norm + c["squares"] / c["n"] - 2 * product / c["n"]

    own = F.filter(clusters, lambda c: c["cluster"].eqNullSafe(F.col("cluster")))[0]
    others = F.filter(clusters, lambda c: ~c["cluster"].eqNullSafe(F.col("cluster")))
    inside = distance(own) * own["n"] / (own["n"] - 1)
    outside = F.array_min(F.transform(others, distance))
    value = F.when(
        (own["n"] > 1) & outside.isNotNull(),
        F.coalesce(F.try_divide(outside - inside, F.greatest(inside, outside)), F.lit(0.0)),
    ).otherwise(0.0)
    return points.agg(F.round(F.avg(value), 6).alias("value")).select(
        F.lit("silhouette").alias("metric"), "value"
    )


def segment_quality(rfm: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    return silhouette(fit_segments(rfm, k, seed)[1])


def _nth(texts: Sequence[str], rank: str | Column) -> Column:
    return F.element_at(F.array(*map(F.lit, texts)), as_column(rank))


def label_segments(segments: DataFrame, labels: Sequence[str] = SEGMENT_LABELS) -> DataFrame:
    """Rank clusters by mean monetary value, richest first, and name them.

    Cluster ids are arbitrary, so only the rank carries meaning. The ranks hold
    one row per cluster, which bounds the window and the broadcast.
    """
    richest = Window.orderBy(F.desc("mean"), F.asc("prediction"))
    ranks = (
        segments.groupBy("prediction")
        .agg((F.sum(cents("monetary")) / F.count("monetary")).alias("mean"))
        .select("prediction", F.row_number().over(richest).alias("segment_rank"))
    )
    ranked = segments.join(F.broadcast(ranks), "prediction")
    return ranked.withColumn("segment", _nth(labels, "segment_rank"))


def segment_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count("*").alias("customers"))


def segment_summary(segments: DataFrame) -> DataFrame:
    """Mean measures per segment, two digits."""
    return segments.groupBy("segment").agg(
        F.round(F.avg("recency"), 2).alias("avg_recency"),
        F.round(F.avg("frequency"), 2).alias("avg_frequency"),
        F.round(money_avg("monetary"), 2).alias("avg_monetary"),
    )


def customer_targeting(
    segments: DataFrame, strategies: Sequence[str] = SEGMENT_STRATEGIES
) -> DataFrame:
    """Size, value and strategy per segment, keyed on the spending rank."""
    return (
        segments.groupBy("segment_rank", "segment")
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.round(money_avg("monetary"), 2).alias("avg_monetary"),
            F.round(F.avg("frequency"), 2).alias("avg_frequency"),
        )
        .withColumn("strategy", _nth(strategies, "segment_rank"))
    )
