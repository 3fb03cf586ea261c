"""Rule-based advice per menu item, and the odd cases worth a look."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions import fixed
from tavola.functions.columns import band, one_row_to_rows


def recommend(classified: DataFrame, wastage: DataFrame | None = None) -> DataFrame:
    """Advice, priority and evidence per classified item.

    ``wastage`` is ``(item_id, wastage_pct)``; items without it count as 0.
    """
    if wastage is None:
        rated = classified.withColumn("wastage_pct", F.lit(0.0))
    else:
        share = wastage.select("item_id", "wastage_pct")
        rated = classified.join(share, "item_id", "left").fillna(
            0, subset=["qty_sold", "revenue", "total_cost", "profit", "profit_pct", "wastage_pct"]
        )
    margin, waste = F.col("profit_pct"), F.col("wastage_pct")

    def in_class(name):
        return F.col("performance_class") == name

    # the first rule that holds
    advice = (
        F.when(in_class(fixed.HIDDEN_OPPORTUNITY) & (margin > 60), fixed.PROMOTE)
        .when(in_class(fixed.LOW_PERFORMER) & (waste > 15), fixed.REVIEW)
        .when(in_class(fixed.LOW_PERFORMER) & (margin < 30), fixed.REMOVE)
        .when(in_class(fixed.VOLUME_DRIVER) & (margin < 40), fixed.REPRICE)
        .when(in_class(fixed.PROFIT_DRIVER), fixed.MAINTAIN)
        .otherwise(fixed.MONITOR)
    )
    evidence = F.format_string(
        "Margin: %s%% | Sold: %s | Wastage: %s%%",
        F.round(margin, 2).cast("string"),
        F.col("qty_sold").cast("string"),
        F.round(waste, 2).cast("string"),
    )
    return (
        rated.withColumn("recommendation", advice)
        .withColumn("priority", band(margin, fixed.PRIORITY_BANDS, fixed.PRIORITY_REST))
        .withColumn("evidence", evidence)
    )


def by_priority(recommendations: DataFrame) -> DataFrame:
    """Most urgent first, by rank and not by the text of the priority."""
    names = [name for _, name in fixed.PRIORITY_BANDS] + [fixed.PRIORITY_REST]
    rank = F.array_position(F.array(*map(F.lit, names)), F.col("priority"))
    return recommendations.orderBy(rank, "item_id")


def recommendation_counts(recommendations: DataFrame) -> DataFrame:
    return recommendations.groupBy("priority").agg(F.count("*").alias("items"))


def tricky_cases(
    classified: DataFrame,
    ratings: DataFrame,
    high_qty: float = 15000,
    low_qty: float = 10000,
    low_margin: float = 40,
    high_margin: float = 60,
    well_rated: float = 4.5,
    badly_rated: float = 3.5,
    require_rating: bool = False,
) -> DataFrame:
    """Four counts in one pass over the classified items.

    An item nobody rated has rating 0, and so counts as badly rated;
    ``require_rating=True`` leaves it out of that case.
    """
    scores = ratings.groupBy("item_id").agg(F.avg("rating").alias("avg_rating"))
    joined = classified.join(scores, "item_id", "left")
    qty, margin, rating = F.col("qty_sold"), F.col("profit_pct"), F.col("avg_rating")
    score = rating if require_rating else F.coalesce(rating, F.lit(0.0))
    counts = joined.agg(
        F.count_if((qty > high_qty) & (margin < low_margin)).alias("high_selling_loss_making"),
        F.count_if((qty < low_qty) & (margin > high_margin)).alias("low_selling_high_margin"),
        F.count_if((score >= well_rated) & (margin < low_margin)).alias("highly_rated_low_profit"),
        F.count_if((score < badly_rated) & (qty > high_qty)).alias("low_rated_high_sales"),
    )
    return one_row_to_rows(counts, "case", "n")
