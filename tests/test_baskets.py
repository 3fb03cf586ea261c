from collections import Counter
from datetime import datetime
from itertools import combinations
from math import ceil
from random import Random

import pytest
from pyspark.sql import functions as F

from tavola.operators import baskets

DAY = datetime(2024, 1, 5)


def lines(make, orders):
    rows = [(f"{o}{n}", o, i, 1, 1.0, 1.0) for o, items in orders.items() for n, i in enumerate(items)]
    return make("order_items", rows)


def frame(spark, sets):
    rows = [(f"O{n}", sorted(s)) for n, s in enumerate(sets)]
    return spark.createDataFrame(rows, "order_id string, items array<string>")


def brute_pairs(sets, k):
    counts = Counter(p for s in sets for p in combinations(sorted(s), 2))
    return sorted(((a, b, n) for (a, b), n in counts.items()), key=lambda r: (-r[2], r[0], r[1]))[:k]


def test_baskets_drop_singles_and_repeats(make, by_key):
    items = lines(make, {"O1": "ABBA", "O2": "AA", "O3": "CA"})
    found = by_key(baskets.baskets(items), "order_id")
    assert {k: v["items"] for k, v in found.items()} == {"O1": ["A", "B"], "O3": ["A", "C"]}
    orders = make("orders", [("O1", "C", "L", DAY, "App", 1.0, "Completed"), ("O3", "C", "L", DAY, "App", 1.0, "Open")])
    assert [r["order_id"] for r in baskets.baskets(items, orders).collect()] == ["O1"]


def test_unsold_lines_only_count_with_orders(make):
    items = make("order_items", [("1", "O1", "A", 0, 1.0, 1.0), ("2", "O1", "B", 1, 1.0, 1.0)])
    orders = make("orders", [("O1", "C", "L", DAY, "App", 1.0, "Completed")])
    assert baskets.baskets(items).count() == 0
    assert baskets.baskets(items, orders).count() == 1


def random_sets(seed, menu, sizes):
    rng = Random(seed)
    names = [f"i{n:03d}" for n in range(menu)]
    weights = [1 / (n + 1) for n in range(menu)]
    return [set(rng.choices(names, weights, k=size)) | set(rng.sample(names, 2)) for size in sizes]


@pytest.mark.parametrize("chunk", [1, 2, 5, 64])
@pytest.mark.parametrize("k", [1, 10, 5000])
def test_bundles_equal_brute_force_whatever_the_chunks(spark, chunk, k):
    """Small chunks cut most baskets into blocks; the result must not move."""
    rng = Random(1)
    sets = random_sets(7, 40, [rng.randint(1, 12) for _ in range(150)])
    found = [tuple(r) for r in baskets.bundle_pairs(frame(spark, sets), k, chunk).collect()]
    assert found == brute_pairs(sets, k)


def test_one_basket_with_the_whole_menu(spark):
    """A basket of 400 items changes the counts but is not spread into its pairs."""
    sets = random_sets(3, 400, [3] * 300) + [{f"i{n:03d}" for n in range(400)}]
    found = [tuple(r) for r in baskets.bundle_pairs(frame(spark, sets), 20).collect()]
    assert found == brute_pairs(sets, 20)


def test_a_basket_of_4000_items_is_spread_over_tasks(spark):
    """One huge order: each task gets a share of its blocks, and each pair is made once."""
    sets = [{f"i{n:04d}" for n in range(4000)}]
    blocks = baskets.basket_blocks(frame(spark, sets), 64)
    shares = [r["count"] for r in blocks.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 63 * 64 // 2 and len(shares) == 8 and max(shares) < 0.2 * sum(shares)
    whole = baskets._pair_counts(frame(spark, sets), 64)
    assert whole.agg(F.sum("pair_count"), F.max("pair_count")).first()[:] == (4000 * 3999 // 2, 1)


def test_baskets_are_built_once_for_all_counts(spark, tmp_path):
    path = str(tmp_path / "lines")
    sets = random_sets(5, 30, [4] * 200)
    rows = [(f"O{n}", i, 1) for n, s in enumerate(sets) for i in s]
    spark.createDataFrame(rows, "order_id string, item_id string, quantity int").write.parquet(path)
    found = baskets.bundle_pairs(baskets.baskets(spark.read.parquet(path)), 20)
    assert [tuple(r) for r in found.collect()] == brute_pairs(sets, 20)
    text = found._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_only_large_baskets(spark):
    sets = [{f"i{n:03d}" for n in range(start, start + 70)} for start in (0, 5, 10)]
    found = [tuple(r) for r in baskets.bundle_pairs(frame(spark, sets), 30).collect()]
    assert found == brute_pairs(sets, 30)


def test_no_baskets(spark):
    assert baskets.bundle_pairs(frame(spark, [{"a", "b"}]).limit(0)).count() == 0


def brute_itemsets(sets, support):
    least = ceil(support * len(sets))
    counts = Counter(
        c for s in sets for size in range(1, len(s) + 1) for c in combinations(sorted(s), size)
    )
    return {c: n for c, n in counts.items() if n >= least}


def test_itemsets_and_rules_equal_brute_force(spark):
    sets = random_sets(5, 6, [3] * 120)
    frequent = brute_itemsets(sets, 0.1)
    rows = baskets.frequent_itemsets(frame(spark, sets), 0.1).collect()
    assert {tuple(r["items"]): r["freq"] for r in rows} == frequent

    expected = {}
    for whole, n in frequent.items():
        for item in whole:
            rest = tuple(x for x in whole if x != item)
            if rest and n / frequent[rest] >= 0.3:
                lift = n / frequent[rest] / (frequent[(item,)] / len(sets))
                expected[rest, item] = (n / len(sets), n / frequent[rest], lift)
    rules = baskets.association_rules(frame(spark, sets), 0.1, 0.3).collect()
    found = {
        (tuple(r["antecedent"]), r["consequent"][0]): (r["support"], r["confidence"], r["lift"])
        for r in rules
    }
    assert found.keys() == expected.keys()
    assert all(found[key] == pytest.approx(expected[key]) for key in expected)

    assert_pair_rules(spark, sets, expected, 0.1)


def test_pair_rules_below_the_broadcast_support(spark):
    sets = random_sets(9, 12, [2] * 80)
    frequent = brute_itemsets(sets, 0.0005)
    expected = {}
    for pair, n in ((c, n) for c, n in frequent.items() if len(c) == 2):
        for left, right in (pair, pair[::-1]):
            if n / frequent[(left,)] >= 0.3:
                lift = n / frequent[(left,)] / (frequent[(right,)] / len(sets))
                expected[(left,), right] = (n / len(sets), n / frequent[(left,)], lift)
    assert_pair_rules(spark, sets, expected, 0.0005)


def assert_pair_rules(spark, sets, expected, support):
    pairs = baskets.pair_rules(frame(spark, sets), support, 0.3).collect()
    singles = {key: value for key, value in expected.items() if len(key[0]) == 1}
    found = {
        ((r["antecedent"],), r["consequent"]): (r["support"], r["confidence"], r["lift"]) for r in pairs
    }
    assert found.keys() == singles.keys()
    assert all(found[key] == pytest.approx(singles[key]) for key in singles)
