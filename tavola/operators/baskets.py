"""Baskets, frequent itemsets, association rules and bundles."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import top_k
from tavola.functions.filters import completed, sold_lines


def baskets(items: DataFrame, orders: DataFrame | None = None, min_size: int = 2) -> DataFrame:
    """The set of items of each order, sorted, for orders of ``min_size`` items.

    With ``orders``, the lines of completed orders; without, sold lines of any
    status. Sets are built on the map side and before the orders join, so however
    often an item is repeated, a basket never holds more than the menu.
    """
    if orders is None:
        return baskets_of(sold_lines(items), min_size)
    done = completed(orders).select("order_id")
    return baskets_of(items, min_size).join(done, "order_id", "left_semi")


def baskets_of(lines: DataFrame, min_size: int = 2) -> DataFrame:
    return (
        lines.groupBy("order_id")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .filter(F.size("items") >= min_size)
    )


def category_lines(items: DataFrame, menu: DataFrame) -> DataFrame:
    """Lines whose item is replaced by its menu category."""
    return items.join(menu.select("item_id", "category"), "item_id").select(
        "order_id", F.col("category").alias("item_id"), "quantity"
    )


def fit_itemsets(
    basket_rows: DataFrame, min_support: float, min_confidence: float = 0.3
) -> FPGrowthModel:
    """FP-Growth. The support bounds what it keeps: at most mean basket size
    divided by ``min_support`` items can be frequent."""
    growth = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    return growth.fit(basket_rows.select("items"))


def itemsets_of(model: FPGrowthModel) -> DataFrame:
    return model.freqItemsets.select(F.sort_array("items").alias("items"), "freq")


def frequent_itemsets(basket_rows: DataFrame, min_support: float) -> DataFrame:
    return itemsets_of(fit_itemsets(basket_rows, min_support))


def top_itemsets(itemsets: DataFrame, k: int = 10) -> DataFrame:
    return top_k(itemsets, k, F.desc("freq"), F.asc("items"))


def rules_of(model: FPGrowthModel) -> DataFrame:
    antecedent = F.sort_array("antecedent").alias("antecedent")
    return model.associationRules.select(
        antecedent, "consequent", "support", "confidence", "lift"
    )


def association_rules(
    basket_rows: DataFrame, min_support: float, min_confidence: float
) -> DataFrame:
    return rules_of(fit_itemsets(basket_rows, min_support, min_confidence))


def top_rules(rules: DataFrame, k: int = 10) -> DataFrame:
    return top_k(rules, k, F.desc("lift"), F.asc("antecedent"), F.asc("consequent"))


def _pairs(basket_rows: DataFrame) -> DataFrame:
    """Each unordered pair of a sorted basket once."""
    rest = F.expr("slice(items, at + 2, size(items))")
    return (
        basket_rows.select("items", F.posexplode("items").alias("at", "item1"))
        .select("item1", F.explode(rest).alias("item2"))
    )


def _side(antecedent: str, consequent: str) -> Column:
    return F.struct(
        F.col(antecedent).alias("antecedent"), F.col(consequent).alias("consequent"), "both"
    )


def pair_rules(basket_rows: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """Rules with one item on each side, counted without FP-Growth.

    Baskets are cut to the frequent items before pairs are made. That loses no
    rule, and at most mean basket size divided by ``min_support`` items are left.
    The number of baskets comes out of the item counts, as that of a null item.
    Spark chooses the join by the size of what is left.
    """
    marked = F.concat("items", F.array(F.lit(None)))
    counts = (
        basket_rows.select(F.explode(marked).alias("item"))
        .groupBy("item")
        .agg(F.count("*").alias("freq"))
    )
    total = counts.filter(F.col("item").isNull()).select("freq").scalar()
    least = F.ceil(total * F.lit(min_support))
    singles = counts.filter(F.col("item").isNotNull() & (F.col("freq") >= least))
    trimmed = (
        basket_rows.select("order_id", F.explode("items").alias("item"))
        .join(singles.select("item"), "item", "left_semi")
        .groupBy("order_id")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    pairs = (
        _pairs(trimmed)
        .groupBy("item1", "item2")
        .agg(F.count("*").alias("both"))
        .filter(F.col("both") >= least)
    )
    sides = pairs.select(
        F.inline(
            F.array(
                _side("item1", "item2"),
                _side("item2", "item1"),
            )
        )
    )
    left = singles.select(F.col("item").alias("antecedent"), F.col("freq").alias("left_freq"))
    right = singles.select(F.col("item").alias("consequent"), F.col("freq").alias("right_freq"))
    confidence = F.col("both") / F.col("left_freq")
    return (
        sides.join(left, "antecedent")
        .join(right, "consequent")
        .filter(confidence >= min_confidence)
        .select(
            "antecedent",
            "consequent",
            (F.col("both") / total).alias("support"),
            confidence.alias("confidence"),
            (confidence / (F.col("right_freq") / total)).alias("lift"),
        )
    )


def basket_blocks(basket_rows: DataFrame, chunk: int = 64) -> DataFrame:
    """Pairs of chunks of each basket: ``(order_id, i, j, left, right)``, i up to j.

    A sorted basket is cut into chunks of ``chunk`` items, and two chunks meet in a row of
    their own, so a basket of n items is about n² / (2 chunk²) rows that go to as many tasks.
    A basket of up to ``chunk`` items is one row. The number of tasks is given, as Spark would
    merge them by the bytes of the chunks, which say little of the pairs.
    """
    tasks = int(basket_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.ceil(F.size("items") / chunk) - 1

    def part(nth: str) -> Column:
        return F.slice("items", F.col(nth) * chunk + 1, F.lit(chunk))

    return (
        basket_rows.select("order_id", "items", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("i"))
        .select("*", F.explode(F.sequence("i", F.ceil(F.size("items") / chunk) - 1)).alias("j"))
        .withColumns({c: F.col(c).cast("int") for c in ("i", "j")})
        .select("order_id", "i", "j", part("i").alias("left"), part("j").alias("right"))
        .repartition(tasks, "order_id", "i", "j")
    )


def _pair_counts(basket_rows: DataFrame, chunk: int) -> DataFrame:
    """``(item1, item2, pair_count)``, item1 before item2, over sorted baskets."""
    later = F.when(F.col("i") < F.col("j"), F.col("right")).otherwise(
        F.expr("slice(left, at + 2, size(left))")
    )
    return (
        basket_blocks(basket_rows, chunk)
        .select("i", "j", "left", "right", F.posexplode("left").alias("at", "item1"))
        .select("item1", F.explode(later).alias("item2"))
        .groupBy("item1", "item2")
        .agg(F.count("*").alias("pair_count"))
    )


def _only(placed: DataFrame, chosen: DataFrame) -> DataFrame:
    """Baskets again, of the chosen items alone, where two of them are left."""
    return (
        placed.join(chosen.select("item"), "item", "left_semi")
        .groupBy("order_id")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .filter(F.size("items") >= 2)
    )


def bundle_pairs(basket_rows: DataFrame, k: int = 50, chunk: int = 64) -> DataFrame:
    """The ``k`` item pairs found together in most orders, exactly.

    A pair is in no more orders than either of its items. The pairs of the most frequent
    items are counted first; the k-th best of them is a bound, and only items that are in
    so many orders themselves can make a better pair. Baskets are cut to those items and
    counted in blocks (:func:`basket_blocks`). The baskets are built once: all three counts
    read the same shuffle.
    """
    placed = basket_rows.select("order_id", F.explode("items").alias("item"))
    frequency = placed.groupBy("item").agg(F.count("*").alias("orders"))
    lead = top_k(frequency, math.ceil(math.sqrt(8 * k)) + 1, F.desc("orders"), F.asc("item"))
    best = top_k(
        _pair_counts(_only(placed, lead), chunk),
        k,
        F.desc("pair_count"),
        F.asc("item1"),
        F.asc("item2"),
    ).agg(F.min("pair_count").alias("n"), F.count("*").alias("pairs"))
    least = best.select(F.when(F.col("pairs") == k, F.col("n")).otherwise(F.lit(1))).scalar()
    counted = _pair_counts(_only(placed, frequency.filter(F.col("orders") >= least)), chunk)
    return top_k(counted, k, F.desc("pair_count"), F.asc("item1"), F.asc("item2"))
