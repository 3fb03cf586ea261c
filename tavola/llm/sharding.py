"""Sharding: whole groups of equal texts dealt to shards of nearly equal bytes.

Karmarkar-Karp differencing: a partial partition is a list of ``shards`` bins. Two partial
partitions are combined by adding the largest bin of one to the smallest of the other, and so
on; the two with the largest spread come first. Groups of at least ``1 / chunk`` of all bytes
(there are ``chunk`` at most) are differenced first. The others are dealt to chunks of a few
thousand, and each chunk is differenced in its own task together with its share, by bytes, of
the partition of the heavy groups: it puts less where these put more. The partial partitions
that are left, one per chunk, are differenced in turn in the same way, until one is left. Rows
then look up the bin of their group.

Rows: nothing is dropped. A missing text has size 1 and forms a group with the other missing
texts; an empty text also has size 1 but is another group. Repeated rows are rows of the same
group. An empty table gives an empty result. A group heavier than an equal share stays whole;
the other shards are then balanced among themselves. Slots follow the order of doc_id (nulls
first) and text hash inside a shard.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tavola.llm.shared import stored
from tavola.llm.tables import text_key

CHUNK = 4096


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (rows of bin sizes) into one.

    Returns the sizes of the last partition and, for each given part and bin, the bin of the
    last partition that it went to. Ties in spread are taken in the order given.
    """
    n, shards = parts.shape
    merged_sizes = [None] * (2 * n - 1)
    children: dict[int, tuple[int, np.ndarray, int, np.ndarray]] = {}
    heap = []
    for k in range(n):
        merged_sizes[k] = parts[k]
        heap.append((-int(parts[k].max() - parts[k].min()), k))
    heapq.heapify(heap)
    new = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        high = np.argsort(-merged_sizes[a], kind="stable")
        low = np.argsort(merged_sizes[b], kind="stable")
        sizes = merged_sizes[a][high] + merged_sizes[b][low]
        to_a, to_b = np.empty(shards, np.int64), np.empty(shards, np.int64)
        to_a[high] = to_b[low] = np.arange(shards)
        children[new] = (a, to_a, b, to_b)
        merged_sizes[new] = sizes
        merged_sizes[a] = merged_sizes[b] = None
        heapq.heappush(heap, (-int(sizes.max() - sizes.min()), new))
        new += 1
    last = heap[0][1]
    place = {last: np.arange(shards)}
    for node in range(new - 1, n - 1, -1):
        a, to_a, b, to_b = children[node]
        at = place.pop(node)
        place[a], place[b] = at[to_a], at[to_b]
    return merged_sizes[last], np.stack([place[k] for k in range(n)])


def _difference_chunk(shards: int, heavy: list[int], light: int):
    """Difference a chunk and its share of ``heavy``, the bins of the heavy groups beside ``light``
    other bytes; the bins of the outcome are named as those of ``heavy``."""
    bins = [f"b{k}" for k in range(shards)]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part", kind="stable")
        parts = frame[bins].to_numpy(np.int64)
        weight = int(parts.sum())
        share = np.array([size * weight // light for size in heavy], dtype=np.int64)
        _, places = difference(np.vstack([share, parts]))
        places = np.argsort(places[0])[places[1:]]
        out = pd.DataFrame(places.astype(np.int32), columns=[f"p{k}" for k in range(shards)])
        out.insert(0, "part", frame["part"].to_numpy())
        out.insert(1, "chunk", frame["chunk"].to_numpy())
        for k in range(shards):
            out[f"b{k}"] = frame[f"b{k}"].to_numpy(np.int64)
        return out

    return run


def shard_groups(groups: DataFrame, shards: int, chunk: int = CHUNK) -> DataFrame:
    """The shard of each group of ``groups`` (part: string key, size: long, above 0).

    A group heavier than the others of its chunk could not be offset inside the chunk, so the
    heavy groups have a task of their own, and every chunk offsets its share of what they leave
    uneven. Any other group is less than ``shards / chunk`` of an equal share. Each level deals the parts to chunks by a hash of their key, so a chunk holds about
    ``chunk`` parts whatever their number; the levels are as many as the logarithm of the
    number of groups to the base ``chunk``.
    """
    bins = [f"b{k}" for k in range(shards)]
    schema = "part string, chunk string, " + ", ".join(
        [f"p{k} int" for k in range(shards)] + [f"b{k} long" for k in range(shards)]
    )
    parts = groups.select(
        "part", F.col("size").alias("b0"), *[F.lit(0).cast("long").alias(b) for b in bins[1:]]
    )
    total = parts.agg(F.sum("b0")).first()[0] or 0
    is_heavy = F.col("b0") >= -(-total // chunk)
    level = parts.where(~is_heavy)
    heavies = stored(
        parts.where(is_heavy)
        .withColumn("chunk", F.lit("heavy"))
        .groupBy("chunk")
        .applyInPandas(_difference_chunk(shards, [0] * shards, 1), schema),
        "heavy",
    ).select("part", F.col("p0").alias("shard"), "b0")
    heavy = [0] * shards
    for shard, size in heavies.groupBy("shard").agg(F.sum("b0")).collect():
        heavy[shard] = size
    light = total - sum(heavy)
    placed = []
    count = level.count()
    while count:
        chunks = -(-count // chunk)
        dealt = level.withColumn(
            "chunk", F.pmod(F.xxhash64("part", F.lit(len(placed))), F.lit(chunks)).cast("string")
        )
        done = stored(
            dealt.groupBy("chunk").applyInPandas(_difference_chunk(shards, heavy, light), schema), "shards"
        )
        placed.append(done.drop(*bins))
        if chunks == 1:
            break
        # sizes of the chunk's own bins: what each part puts into them
        level = done.groupBy(F.col("chunk").alias("part")).agg(
            *[
                F.sum(
                    sum(
                        (F.when(F.col(f"p{j}") == k, F.col(f"b{j}")).otherwise(0) for j in range(shards)),
                        F.lit(0),
                    )
                ).alias(f"b{k}")
                for k in range(shards)
            ]
        )
        count = chunks
    heavies = heavies.select("part", "shard")
    if not placed:
        return heavies
    found = placed[0].select("part", "chunk", F.col("p0").alias("shard"))
    for upper in placed[1:]:
        up = upper.select(
            F.col("part").alias("_chunk"),
            F.col("chunk").alias("_next"),
            F.array(*[f"p{k}" for k in range(shards)]).alias("_to"),
        )
        found = found.join(up, found["chunk"] == up["_chunk"]).select(
            "part", F.col("_next").alias("chunk"), F.get("_to", F.col("shard")).alias("shard")
        )
    return found.select("part", "shard").union(heavies)


def shard_documents(docs: DataFrame, shards: int = 8, chunk: int = CHUNK) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    Size is the UTF-8 bytes of the text plus one. The law is ``bytes``: sizes near equal.
    """
    binary = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(binary) + 1).cast("long").alias("size"),
        F.crc32(binary).alias("text_crc32"),
        text_key().alias("part"),
    )
    rows = stored(rows, "sizes")
    groups = stored(rows.groupBy("part").agg(F.sum("size").alias("size")), "groups")
    placed = rows.join(shard_groups(groups, shards, chunk), "part")
    # rows that are equal in all else are told apart, so that they need not be in one range
    placed = stored(placed.withColumn("tie", F.monotonically_increasing_id()), "placed")
    order = ["shard", F.col("doc_id").asc_nulls_first(), "part", "tie"]
    # ids that grow along a range-partitioned sort: the partition, and the place in it
    numbered = stored(placed.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "numbered")
    lane = F.shiftright("at", 33)
    lanes = numbered.groupBy("shard", lane.alias("lane")).agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first")
    )
    before = stored(_before(lanes), "lanes")
    return (
        numbered.withColumn("lane", lane)
        .join(before, ["shard", "lane"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("before") + F.col("at") - F.col("first")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def _before(lanes: DataFrame) -> DataFrame:
    """``lanes`` with the rows of the same shard in lower lanes; each shard has a lane for each
    partition of the sort at most, whatever the ids."""
    lower = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    return lanes.withColumn("before", F.coalesce(F.sum("n").over(lower), F.lit(0))).drop("n")
