import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tavola.llm import sharding


@pytest.mark.parametrize("chunk", (4096, 7))
def test_groups_stay_whole_and_shards_are_balanced(spark, docs_of, chunk):
    rng = random.Random(chunk)
    texts = ["x" * rng.randint(0, 900) + str(k) for k in range(150)]
    docs = [(i, rng.choice(texts)) for i in range(400)] + [(5, texts[0]), (None, texts[1]), (None, None), (900, None), (901, "")]
    rows = sharding.shard_documents(docs_of(docs), chunk=chunk).collect()
    assert len(rows) == len(docs)
    by_id = defaultdict(list)
    for i, text in docs:
        by_id[i].append((len((text or "").encode()) + 1, zlib.crc32((text or "").encode())))
    total, slots, group = defaultdict(int), defaultdict(list), {}
    for r in rows:
        assert (r["size"], r["text_crc32"]) in by_id[r["doc_id"]]
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 8
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        if r["size"] > 1:
            assert group.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(total.values()) - min(total.values()) <= 0.02 * sum(total.values()) / 8


def test_differencing_beats_greedy_and_keeps_sums():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = rng.integers(1, 10_000, 60)
        parts = np.zeros((60, 4), dtype=np.int64)
        parts[:, 0] = sizes
        last, places = sharding.difference(parts)
        got = np.zeros(4, dtype=np.int64)
        np.add.at(got, places[:, 0], sizes)
        assert (got == last).all() and all(sorted(p) == [0, 1, 2, 3] for p in places.tolist())
        greedy = np.zeros(4, dtype=np.int64)
        for s in sorted(sizes.tolist(), reverse=True):
            greedy[greedy.argmin()] += s
        assert np.ptp(got) <= max(np.ptp(greedy), 5)


def test_hot_group(spark, docs_of):
    docs = [(i, "hot " * 50) for i in range(300)] + [(1000 + i, f"text {i} " * 20) for i in range(500)]
    rows = sharding.shard_documents(docs_of(docs)).collect()
    total = defaultdict(int)
    for r in rows:
        total[r["shard"]] += r["size"]
    hot = {r["shard"] for r in rows if r["doc_id"] < 300}
    others = [v for k, v in total.items() if k not in hot]
    assert len(hot) == 1 and max(others) - min(others) <= 400


def test_slots_of_sparse_and_repeated_ids(spark, docs_of, monkeypatch):
    rng, lanes = random.Random(3), []

    def noted(df, name):
        out = stored(df, name)
        lanes.extend([out.count()] if name == "lanes" else [])
        return out

    stored = sharding.stored
    monkeypatch.setattr(sharding, "stored", noted)
    docs = [(rng.randint(-(1 << 63), (1 << 63) - 1), f"text {k}") for k in range(2000)]
    docs += [(None, f"none {k % 50}") for k in range(600)] + [(77, "same")] * 400
    rows = sharding.shard_documents(docs_of(docs).repartition(7)).collect()
    assert len(rows) == len(docs)
    # lanes follow the partitions of the sort, not the ids
    assert lanes[0] <= int(spark.conf.get("spark.sql.shuffle.partitions")) + 8
    for shard in range(8):
        mine = sorted((r for r in rows if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in mine] == list(range(len(mine)))
        ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in mine]
        assert ids == sorted(ids)


def test_empty_table(spark, docs_of):
    assert sharding.shard_documents(docs_of([(1, "x")]).limit(0)).collect() == []


@pytest.mark.parametrize("percent", (3, 10, 33))
def test_a_heavy_group_is_offset_by_all_chunks(spark, percent):
    rng = random.Random(percent)
    sizes = {f"g{k}": rng.randint(500, 20_000) for k in range(3000)}
    sizes["heavy"] = sum(sizes.values()) * percent // (100 - percent)
    groups = spark.createDataFrame(list(sizes.items()), "part string, size long")
    rows = sharding.shard_groups(groups, 8, chunk=64).collect()
    assert sorted(r["part"] for r in rows) == sorted(sizes)
    total = [0] * 8
    for r in rows:
        total[r["shard"]] += sizes[r["part"]]
    share = sum(total) / 8
    assert max(total) <= max(1.001 * share, sizes["heavy"])
    others = sorted(total)[: 7 if sizes["heavy"] > share else 8]
    assert others[-1] - others[0] <= 0.002 * share


def test_differencing_is_the_plain_one():
    """Partitions as lists of bins of members, combined two at a time, the widest spread first."""
    rng = np.random.default_rng(4)
    for _ in range(20):
        sizes = rng.integers(1, 60, 40).tolist()
        partitions = [[(size, [k]), (0, []), (0, [])] for k, size in enumerate(sizes)]
        while len(partitions) > 1:
            spreads = [max(b[0] for b in p) - min(b[0] for b in p) for p in partitions]
            first, second = sorted(range(len(partitions)), key=lambda k: -spreads[k])[:2]
            high = sorted(partitions[first], key=lambda b: -b[0])
            low = sorted(partitions[second], key=lambda b: b[0])
            partitions = [p for k, p in enumerate(partitions) if k not in (first, second)]
            partitions.append([(a + b, x + y) for (a, x), (b, y) in zip(high, low)])
        parts = np.zeros((len(sizes), 3), dtype=np.int64)
        parts[:, 0] = sizes
        last, places = sharding.difference(parts)
        assert last.tolist() == [size for size, _ in partitions[0]]
        for bin_, (_, members) in enumerate(partitions[0]):
            assert sorted(members) == np.flatnonzero(places[:, 0] == bin_).tolist()
