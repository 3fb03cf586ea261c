import random

import pytest

from tavola.llm import decontaminate


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []


def mass(some):
    return sum(len(w) for s in some for w in s)


def brute(docs, items):
    out = {}
    for i, text in docs:
        have = shingles((text or "").lower().split())
        for k, item in items:
            wanted = set(shingles((item or "").lower().split()))
            width = min(max(len((item or "").split()) - 4, 1), len(have))
            best = None
            for a in range(len(have) - width + 1):
                window = set(have[a : a + width])
                union = mass(window | wanted)
                if wanted and union and 100 * mass(window & wanted) >= 80 * union:
                    similarity = mass(window & wanted) / union
                    best = max(best or (0, 0), (similarity, -a))
            if best:
                out[i, k] = (best[0], -best[1])
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(some(rng.randint(12, 60)))) for k in range(25)] + [(90, "tiny one here"), (91, None), (92, "")]
    docs = []
    for i in range(150):
        words = some(rng.choice((0, 3, 20, 200, 900)))
        if rng.random() < 0.6:
            item = rng.choice(items[:25])[1].split()
            for _ in range(rng.choice((0, 0, 1, 2, 6))):
                item[rng.randrange(len(item))] = rng.choice(vocab)
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() for w in item] if rng.random() < 0.2 else item
        docs.append((i, "  ".join(words)))
    docs += [(900, None), (901, ""), (902, "tiny one here"), (903, items[0][1])]
    return docs, items


def test_equals_brute_force(spark, docs_of, tables):
    docs, items = tables
    benchmark = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, doc_id int")
    rows = decontaminate.find(docs_of(docs), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_word"]) for r in rows} == brute(docs, items)
    kept = decontaminate.keep_clean(docs_of(docs), benchmark)
    assert kept.schema == docs_of(docs).schema
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in brute(docs, items)}


def test_blocks_of_items_change_nothing(spark, docs_of, tables, monkeypatch):
    docs, items = tables
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in decontaminate.find(docs_of(docs), benchmark).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1500)
    assert {tuple(r) for r in decontaminate.find(docs_of(docs), benchmark).collect()} == whole


def test_index_finds_all_within_the_radius():
    rng = random.Random(1)
    texts = [" ".join(str(rng.random()) for _ in range(20)) for _ in range(60)]
    index = decontaminate.Index(list(range(60)), texts, 80)
    import numpy as np

    base = index.finger[np.array([rng.randrange(60) for _ in range(400)])]
    flips = np.array([sum(1 << b for b in rng.sample(range(64), rng.randint(0, 25))) for _ in range(400)], dtype=np.uint64)
    finger = base ^ flips
    window, item, distance = index.candidates(finger, np.full(400, 20))
    near = np.bitwise_count(finger[:, None] ^ index.finger[None, :])
    expected = {(w, i) for w, i in zip(*np.nonzero(near <= decontaminate.RADIUS))}
    assert set(zip(window.tolist(), item.tolist())) == {(int(w), int(i)) for w, i in expected}


def test_empty_tables(spark, docs_of):
    benchmark = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    docs = docs_of([(1, "a b c d e f g")])
    assert decontaminate.find(docs.limit(0), benchmark).collect() == []
    assert decontaminate.find(docs, benchmark.limit(0)).collect() == []
    assert decontaminate.keep_clean(docs, benchmark.limit(0)).count() == 1
