"""Recency, frequency and monetary value, churn, loyalty and baskets per customer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions.columns import band, day, money_sum, share_shuffle, weekend_flag
from tavola.functions.filters import completed, paid, sold_lines
from tavola.functions.fixed import CHURN_BANDS, CHURN_REST
from tavola.functions.lines import completed_lines, sold_and_paid


def rfm(orders: DataFrame, as_of: date | None = None, offset_days: int = 0) -> DataFrame:
    """Recency in days, order count and money per customer, over completed orders.

    Recency is counted from ``as_of`` (by default the last order date of all
    customers) plus ``offset_days``.
    """
    each = _per_customer(completed(orders), F.max(day("order_date")), F.count("*"))
    latest = F.lit(as_of) if as_of is not None else _latest(each)
    recency = F.date_diff(F.date_add(latest, offset_days), F.col("last_order"))
    return each.select("customer_id", recency.alias("recency"), "frequency", "monetary")


def _per_customer(orders: DataFrame, last_order: Column, frequency: Column) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        last_order.alias("last_order"),
        frequency.alias("frequency"),
        money_sum("total_amount").alias("monetary"),
    )


def _latest(each: DataFrame) -> Column:
    """The last order of all customers, from the shuffle that ``each`` makes anyway."""
    shared = share_shuffle(each, "frequency", measures=("monetary",))
    return shared.agg(F.max("last_order")).scalar()


def rfm_elapsed(orders: DataFrame) -> DataFrame:
    """RFM over paid orders, recency in full days from one day after the last order.

    The time of day counts here: a day has passed after 24 hours.
    """
    done = paid(orders).filter(F.col("customer_id").isNotNull())
    each = _per_customer(done, F.max("order_date"), F.count("order_id"))
    passed = F.timestamp_diff("DAY", F.col("last_order"), _latest(each))
    return each.select(
        "customer_id", (passed + 1).cast("int").alias("recency"), "frequency", "monetary"
    )


def churn_risk(orders: DataFrame) -> DataFrame:
    """Days since the last paid order, and its risk class."""
    each = _per_customer(paid(orders), F.max(day("order_date")), F.count("order_id"))
    return (
        each.withColumn("recency", F.date_diff(_latest(each), F.col("last_order")))
        .withColumn("churn_risk", band("recency", CHURN_BANDS, CHURN_REST))
    )


def churn_headline(churn: DataFrame) -> DataFrame:
    (_, highest), *_ = CHURN_BANDS
    return churn.agg(
        F.count_if(F.col("churn_risk") == highest).alias("high_risk"),
        F.count_if(F.col("churn_risk") == CHURN_REST).alias("active"),
    )


def category_diversity(items: DataFrame, orders: DataFrame, menu: DataFrame) -> DataFrame:
    return category_diversity_of(completed_lines(items, orders), menu)


def category_diversity_of(lines: DataFrame, menu: DataFrame) -> DataFrame:
    """How many categories each customer has bought from."""
    return (
        sold_and_paid(lines)
        .select("customer_id", "item_id")
        .distinct()
        .join(menu.select("item_id", "category"), "item_id")
        .groupBy("customer_id")
        .agg(F.countDistinct("category").alias("category_diversity"))
    )


def churn_enhanced(churn: DataFrame, diversity: DataFrame) -> DataFrame:
    return churn.join(diversity, "customer_id", "left").fillna(
        0, subset=["frequency", "monetary", "recency", "category_diversity"]
    )


def repeat_purchase_rate(
    items: DataFrame, orders: DataFrame, distinct_orders: bool = False
) -> DataFrame:
    return repeat_purchase_rate_of(completed_lines(items, orders), distinct_orders)


def repeat_purchase_rate_of(lines: DataFrame, distinct_orders: bool = False) -> DataFrame:
    """Percent of an item's customers with more than one line of it.

    Two lines of one order count as a repeat; ``distinct_orders=True`` asks for
    two orders instead.
    """
    bought = F.countDistinct("order_id") if distinct_orders else F.count("order_id")
    return (
        sold_and_paid(lines)
        .groupBy("item_id", "customer_id")
        .agg((bought > 1).cast("int").alias("repeat"))
        .groupBy("item_id")
        .agg(F.round(F.avg("repeat") * 100, 2).alias("repeat_purchase_rate"))
    )


def weekend_ratio(items: DataFrame, orders: DataFrame) -> DataFrame:
    return weekend_ratio_of(completed_lines(items, orders))


def weekend_ratio_of(lines: DataFrame) -> DataFrame:
    """Percent of an item's lines that were ordered at a weekend."""
    share = F.round(F.avg(weekend_flag("order_date")) * 100, 2)
    return sold_and_paid(lines).groupBy("item_id").agg(share.alias("weekend_ratio_pct"))


def weekend_only_items(ratio: DataFrame, min_pct: float = 60) -> DataFrame:
    return ratio.filter(F.col("weekend_ratio_pct") > min_pct)


def basket_size(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean number of items in a customer's orders.

    Lines are summed per order before the join, on the key the join needs.
    """
    per_order = sold_lines(items).groupBy("order_id").agg(F.sum("quantity").alias("in_order"))
    owned = per_order.join(paid(orders).select("order_id", "customer_id"), "order_id")
    return _mean_order(owned, "in_order")


def basket_size_of(lines: DataFrame) -> DataFrame:
    return _mean_order(sold_and_paid(lines), "quantity")


def _mean_order(rows: DataFrame, quantity: str) -> DataFrame:
    return (
        rows.groupBy("customer_id", "order_id")
        .agg(F.sum(quantity).alias("in_order"))
        .groupBy("customer_id")
        .agg(F.round(F.avg("in_order"), 2).alias("avg_basket_size"))
    )


def segment_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Compare two labelings, each ``(customer_id, segment)``."""
    left = a.select("customer_id", F.col("segment").alias("left_segment"))
    right = b.select("customer_id", F.col("segment").alias("right_segment"))
    same = F.col("left_segment") == F.col("right_segment")
    return (
        left.join(right, "customer_id")
        .agg(F.count("*").alias("total"), F.count_if(same).alias("matches"))
        .select(
            "total",
            "matches",
            (F.col("total") - F.col("matches")).alias("mismatches"),
            F.round(F.try_divide(F.col("matches"), F.col("total")) * 100, 2).alias("agreement_pct"),
        )
    )


#: Labels that a segmentation may have where they are matched; the table of counts that is
#: matched then has at most the square of it.
MOST_LABELS = 64


def contingency(a: DataFrame, b: DataFrame) -> DataFrame:
    """Customers per pair of labels of two segmentations, each ``(customer_id, segment)``."""
    left = a.select("customer_id", F.col("segment").alias("left_segment"))
    right = b.select("customer_id", F.col("segment").alias("right_segment"))
    return (
        left.join(right, "customer_id")
        .groupBy("left_segment", "right_segment")
        .agg(F.count("*").alias("customers"))
    )


def _assignment(counts: list[list[int]]) -> list[int]:
    """The column of each row of a square table, so that the counts there add up to the most.

    Shortest augmenting paths with potentials, over costs that are the negated counts.
    """
    n = len(counts)
    row_price, column_price, row_of = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for row in range(1, n + 1):
        row_of[0], column = row, 0
        least, come_from, used = [float("inf")] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        while row_of[column]:
            used[column] = True
            here, step, best = row_of[column], float("inf"), 0
            for c in range(1, n + 1):
                if used[c]:
                    continue
                slack = -counts[here - 1][c - 1] - row_price[here] - column_price[c]
                if slack < least[c]:
                    least[c], come_from[c] = slack, column
                if least[c] < step:
                    step, best = least[c], c
            for c in range(n + 1):
                if used[c]:
                    row_price[row_of[c]] += step
                    column_price[c] -= step
                else:
                    least[c] -= step
            column = best
        while column:
            row_of[column] = row_of[come_from[column]]
            column = come_from[column]
    found = [0] * n
    for c in range(1, n + 1):
        found[row_of[c] - 1] = c - 1
    return found


def _pairs_of(n: int) -> int:
    return n * (n - 1) // 2


def matched_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Agreement of two segmentations whose labels need not have the same names.

    Labels are matched one to one so that most customers agree. ``adjusted_rand`` compares
    pairs of customers and needs no match: 1 for equal partitions, about 0 for unrelated ones;
    null where both put all customers together or all apart. Only the table of label counts
    leaves the cluster; more than ``MOST_LABELS`` labels are an error.
    """
    spark = a.sparkSession
    cells = contingency(a, b).limit(MOST_LABELS**2 + 1).collect()
    left = sorted({c["left_segment"] for c in cells}, key=str)
    right = sorted({c["right_segment"] for c in cells}, key=str)
    if max(len(left), len(right)) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    n = max(len(left), len(right))
    counts = [[0] * n for _ in range(n)]
    for c in cells:
        counts[left.index(c["left_segment"])][right.index(c["right_segment"])] = c["customers"]
    total = sum(map(sum, counts))
    matches = sum(counts[row][column] for row, column in enumerate(_assignment(counts)))
    together = sum(_pairs_of(c) for row in counts for c in row)
    in_left = sum(_pairs_of(sum(row)) for row in counts)
    in_right = sum(_pairs_of(sum(row[c] for row in counts)) for c in range(n))
    expected = in_left * in_right / _pairs_of(total) if total > 1 else 0.0
    most = (in_left + in_right) / 2
    rand = round((together - expected) / (most - expected), 6) if most != expected else None
    row = (total, matches, total - matches, round(matches / total * 100, 2) if total else None, rand)
    return spark.createDataFrame(
        [row], "total long, matches long, mismatches long, agreement_pct double, adjusted_rand double"
    )
