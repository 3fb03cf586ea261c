"""Connected components of edges between 64-bit keys, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.llm.shared import stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node that it reaches, of all nodes of ``edges`` (a, b).

    Each round links the neighbours above a node to the smallest neighbour, then those below to
    the smallest (large star and small star). No round lengthens a path, and the number of
    rounds grows with the logarithm of the number of nodes. A node of many neighbours is
    aggregated per task before the shuffle. Edges without an end are left out.
    """
    links = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(),
        "links",
    )
    state = None
    for _ in range(most_rounds):
        both = links.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(
            links.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
        )
        least = both.groupBy("n").agg(F.min("m").alias("least"))
        # large star: every neighbour above a node goes to the least of the node and its neighbours
        large = (
            both.where("m > n")
            .join(least, "n")
            .select(F.col("m").alias("hi"), F.least("n", "least").alias("lo"))
            .distinct()
        )
        # small star: every neighbour below a node, and the node, go to the least of them
        below = large.groupBy("hi").agg(F.min("lo").alias("least"))
        small = (
            large.join(below, "hi")
            .where("lo <> least")
            .select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
            .union(below.select("hi", F.col("least").alias("lo")))
            .distinct()
        )
        links = stored(small, "links")
        seen = links.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0)).alias("s"),
        ).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.union(links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
