from datetime import date, datetime, timedelta

from itertools import combinations, permutations
from random import Random

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler

from tavola.operators import customers, segments

LAST = datetime(2024, 12, 31, 10)


def order(oid, customer, when, amount=10.0, status="Completed"):
    return (oid, customer, "L1", when, "App", amount, status)


def line(oid, item, qty=1, lid="1"):
    return (lid, oid, item, qty, 1.0, 1.0)


def test_rfm_and_its_elapsed_variant(make, by_key):
    rows = [
        order("O1", "C1", LAST, 5.05),
        order("O2", "C1", LAST - timedelta(days=9), 1.0),
        order("O3", "C2", datetime(2024, 12, 30, 23, 59, 30)),
        order("O4", "C3", LAST - timedelta(days=3), 0.0),
        order("O5", "C4", LAST + timedelta(days=9), status="Cancelled"),
        order("O6", "C5", None),
    ]
    df = make("orders", rows)
    found = by_key(customers.rfm(df), "customer_id")
    assert found["C1"] == {"customer_id": "C1", "recency": 0, "frequency": 2, "monetary": 6.05}
    assert found["C2"]["recency"] == 1
    assert found["C3"]["recency"] == 3
    assert found["C5"]["recency"] is None
    assert "C4" not in found
    assert by_key(customers.rfm(df, date(2025, 1, 2), 1), "customer_id")["C1"]["recency"] == 3
    elapsed = by_key(customers.rfm_elapsed(df), "customer_id")
    # One day and ten hours have passed since the order of C2.
    assert (elapsed["C1"]["recency"], elapsed["C2"]["recency"]) == (1, 1)
    assert "C3" not in elapsed


@pytest.mark.parametrize(
    ("days", "risk"),
    [(60, "Active"), (61, "Low Risk"), (90, "Low Risk"), (91, "Medium Risk"), (180, "Medium Risk"), (181, "High Risk")],
)
def test_churn_bands(make, by_key, days, risk):
    df = make("orders", [order("O1", "C1", LAST), order("O2", "C2", LAST - timedelta(days=days))])
    churn = customers.churn_risk(df)
    assert by_key(churn, "customer_id")["C2"]["churn_risk"] == risk
    assert customers.churn_headline(churn).first()["high_risk"] == int(days > 180)


def test_diversity_fills_zero(make, by_key):
    orders = make("orders", [order("O1", "C1", LAST), order("O2", "C2", LAST)])
    items = make("order_items", [line("O1", "A"), line("O1", "B"), line("O1", "C"), line("O2", "A", 0)])
    menu = make("menu_items", [("A", "a", "x", 1.0, 1.0, True), ("B", "b", "x", 1.0, 1.0, True), ("C", "c", "y", 1.0, 1.0, True)])
    diversity = customers.category_diversity(items, orders, menu)
    found = by_key(customers.churn_enhanced(customers.churn_risk(orders), diversity), "customer_id")
    assert {k: v["category_diversity"] for k, v in found.items()} == {"C1": 2, "C2": 0}


def test_two_lines_of_one_order_are_a_repeat(make):
    orders = make("orders", [order("O1", "C1", LAST), order("O2", "C2", LAST)])
    items = make("order_items", [line("O1", "A"), line("O1", "A", lid="2"), line("O2", "A")])
    assert customers.repeat_purchase_rate(items, orders).first()["repeat_purchase_rate"] == 50.0
    strict = customers.repeat_purchase_rate(items, orders, distinct_orders=True)
    assert strict.first()["repeat_purchase_rate"] == 0.0


def test_weekend_share(make, by_key):
    days = {"O1": datetime(2024, 1, 6), "O2": datetime(2024, 1, 7), "O3": datetime(2024, 1, 5)}
    orders = make("orders", [order(oid, "C1", when) for oid, when in days.items()])
    items = make("order_items", [line("O1", "A"), line("O2", "A"), line("O3", "A"), line("O3", "B")])
    ratio = customers.weekend_ratio(items, orders)
    assert by_key(ratio, "item_id")["A"]["weekend_ratio_pct"] == 66.67
    assert [r["item_id"] for r in customers.weekend_only_items(ratio).collect()] == ["A"]


def test_basket_size_averages_orders(make, by_key):
    orders = make("orders", [order("O1", "C1", LAST), order("O2", "C1", LAST), order("O3", "C2", LAST, status="Cancelled")])
    items = make("order_items", [line("O1", "A", 2), line("O1", "B", 3), line("O2", "A", 1), line("O2", "A", -4), line("O3", "A", 9)])
    assert by_key(customers.basket_size(items, orders), "customer_id") == {
        "C1": {"customer_id": "C1", "avg_basket_size": 3.0}
    }


def test_agreement(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "x")], "customer_id string, segment string")
    b = spark.createDataFrame([("1", "x"), ("2", "x"), ("9", "x")], "customer_id string, segment string")
    assert customers.segment_agreement(a, b).first().asDict() == {
        "total": 2, "matches": 1, "mismatches": 1, "agreement_pct": 50.0
    }
    assert customers.segment_agreement(a, b.limit(0)).first()["agreement_pct"] is None


def test_segments_are_ranked_by_spending(spark):
    rows = [
        (f"C{n}", 10 * (n % 5), 2 + n % 5, float(100 * (n % 5) + n % 3)) for n in range(200)
    ]
    rfm = spark.createDataFrame(rows, "customer_id string, recency int, frequency long, monetary double")
    labelled = segments.label_segments(segments.kmeans_segments(rfm))
    assert labelled.count() == labelled.select("customer_id").distinct().count() == 200
    targeting = segments.customer_targeting(labelled).orderBy("segment_rank").collect()
    assert [r["segment"] for r in targeting] == list(segments.SEGMENT_LABELS)
    assert [r["strategy"] for r in targeting] == list(segments.SEGMENT_STRATEGIES)
    means = [r["avg_monetary"] for r in targeting]
    assert means == sorted(means, reverse=True) and len(set(means)) == 5
    assert sum(r["customers"] for r in segments.segment_counts(labelled).collect()) == 200
    assert segments.segment_summary(labelled).count() == 5
    quality = segments.segment_quality(rfm).first()
    assert quality["metric"] == "silhouette" and 0.5 < quality["value"] <= 1


def test_labels_do_not_depend_on_cluster_ids(spark, by_key):
    rows = [("a", 0, 5.0), ("b", 1, 9.0), ("c", 2, 7.0)]
    schema = "customer_id string, prediction int, monetary double"
    found = by_key(segments.label_segments(spark.createDataFrame(rows, schema)), "customer_id")
    moved = [(c, (p + 1) % 3, m) for c, p, m in rows]
    other = by_key(segments.label_segments(spark.createDataFrame(moved, schema)), "customer_id")
    assert {k: v["segment"] for k, v in found.items()} == {
        "b": "High-Value Loyal", "c": "Frequent", "a": "Promotion-Driven"
    }
    assert {k: v["segment"] for k, v in other.items()} == {k: v["segment"] for k, v in found.items()}


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "customer_id string, segment string")


def brute_match(pairs):
    """All one-to-one matches of labels, and pairs of customers counted one by one."""
    left, right = sorted({a for a, _ in pairs}), sorted({b for _, b in pairs})
    n = max(len(left), len(right))
    left, right = left + [None] * (n - len(left)), right + [None] * (n - len(right))
    best = max(sum(dict(zip(left, order)).get(a) == b for a, b in pairs) for order in permutations(right))
    both = in_left = in_right = total = 0
    for (a, b), (c, d) in combinations(pairs, 2):
        total, both = total + 1, both + (a == c and b == d)
        in_left, in_right = in_left + (a == c), in_right + (b == d)
    expected = in_left * in_right / total
    most = (in_left + in_right) / 2
    return best, None if most == expected else round((both - expected) / (most - expected), 6)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matched_agreement_against_brute_force(spark, seed):
    rng = Random(seed)
    pairs = [(rng.choice("abcde"), rng.choice("vwxy")) for _ in range(120)]
    pairs = [(a, "vwxyz"["abcde".index(a)] if rng.random() < 0.6 else b) for a, b in pairs]
    a = labels(spark, [(str(n), x) for n, (x, _) in enumerate(pairs)])
    b = labels(spark, [(str(n), y) for n, (_, y) in enumerate(pairs)])
    row = customers.matched_agreement(a, b).first()
    matches, rand = brute_match(pairs)
    assert (row["total"], row["matches"], row["mismatches"]) == (120, matches, 120 - matches)
    assert row["adjusted_rand"] == pytest.approx(rand)


def test_permuted_labels_agree_wholly(spark):
    a = labels(spark, [(str(n), "abc"[n % 3]) for n in range(30)])
    b = labels(spark, [(str(n), "bca"[n % 3]) for n in range(30)])
    assert customers.segment_agreement(a, b).first()["agreement_pct"] == 0.0
    assert customers.matched_agreement(a, b).first()[:] == (30, 30, 0, 100.0, 1.0)
    assert customers.matched_agreement(a, b.limit(0)).first()[:] == (0, 0, 0, None, None)
    many = labels(spark, [(str(n), str(n)) for n in range(80)])
    with pytest.raises(ValueError):
        customers.matched_agreement(many, many)


def test_silhouette_is_that_of_the_evaluator(spark):
    rng = Random(5)
    rows = [(str(n), rng.randrange(100), rng.randrange(9), rng.random() * 500, n % 4) for n in range(300)]
    rows.append(("alone", 500, 1, 1.0, 9))
    df = spark.createDataFrame(rows, "customer_id string, recency int, frequency int, monetary double, prediction int")
    assembled = VectorAssembler(inputCols=list(segments.MEASURES), outputCol="raw").transform(df)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(assembled)
    expected = ClusteringEvaluator(featuresCol="features").evaluate(scaler.transform(assembled))
    assert segments.silhouette(df).first()["value"] == pytest.approx(expected, abs=1e-6)
    assert segments.silhouette(df.filter("prediction = 1")).first()["value"] == 0.0
