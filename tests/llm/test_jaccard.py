import hashlib
import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tavola.llm import jaccard


def grams(text, n):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    w = [x for x in lowered.split(" ") if x]
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}


def brute(docs, n, percent):
    """(n_shingles, smallest id reached) by comparing all pairs."""
    sets = [grams(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        least[root(k)] = min(least.get(root(k), i), i)
    return [(len(sets[k]), least[root(k)]) for k in range(len(docs))]


def corpus(rng, size):
    docs, vocab = [], [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocab) for _ in range(30)]
    for i in range(size):
        if docs and rng.random() < 0.6:
            w = rng.choice(docs)[1].split(" ")
            w = [x if rng.random() > rng.choice((0, 0.01, 0.03, 0.1)) else rng.choice(vocab).upper() for x in w]
        else:
            w = [rng.choice(vocab) for _ in range(rng.choice((1, 2, 4, 10, 40, 150, 400)))]
            if rng.random() < 0.3:
                w += passage
        docs.append((i + 1, " ".join(w)))
    return docs


@pytest.mark.parametrize("n, percent, block, hot", [(3, 90, 256, 64), (5, 80, 256, 64), (3, 80, 4, 2)])
def test_equals_brute_force(spark, docs_of, monkeypatch, n, percent, block, hot):
    monkeypatch.setattr(jaccard, "HOT", hot)
    docs = corpus(random.Random(n + percent), 150) + [(900, None), (901, ""), (902, " \n "), (903, "W1"), (904, "w1")]
    random.Random(1).shuffle(docs)
    rows = jaccard.join(docs_of(docs), n, percent, block).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert len(rows) == len(docs)
    assert [got[i] for i, _ in docs] == brute(docs, n, percent)


@pytest.mark.parametrize("percent", (80, 90))
def test_tree_and_keys_lose_no_link(percent):
    rng = np.random.default_rng(percent)
    frequency = rng.integers(0, 5, 1 << jaccard.BITS)

    for _ in range(25):
        base = [rng.integers(0, 1 << 63, int(rng.integers(1, 80)), dtype=np.uint64) for _ in range(5)]
        sets = {}
        for _ in range(50):
            b = base[rng.integers(0, 5)]
            some = b[rng.random(len(b)) > rng.random() * 0.2]
            s = np.unique(np.concatenate([some, rng.integers(0, 1 << 63, int(rng.integers(0, 4)), dtype=np.uint64)]))
            if len(s):
                sets[tuple(s.tolist())] = s
        sets = list(sets.values())
        places = np.arange(len(sets))
        x, y = jaccard.tree_links(sets, places, places, percent)
        links = {
            (a, b)
            for a in places.tolist()
            for b in places.tolist()
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= percent * len(np.union1d(sets[a], sets[b]))
        }
        assert set(zip(x.tolist(), y.tolist())) == links and len(x) == len(links)
        size = np.array([len(s) for s in sets])
        key, row = jaccard.first_shingles(
            np.concatenate(sets), np.repeat(places, size), size, frequency, percent
        )
        made = [set(key[row == k].tolist()) for k in places]
        need = jaccard.prefix(size, percent)[1]
        for a, b in links:
            assert len(made[a] & made[b]) >= min(need[a], need[b])


def test_many_different_near_copies_and_strays(spark, docs_of, monkeypatch):
    """A group of far more than one block: near copies that are all different, chains at its rim,
    and texts that share keys with it and do not link."""
    monkeypatch.setattr(jaccard, "HOT", 8)
    words_of = [f"w{j}" for j in range(60)]
    docs = []
    for k in range(600):
        text = list(words_of)
        text[k % 60] = f"x{k}"
        docs.append((k, " ".join(text)))
    chain = list(words_of)
    for k in range(30):  # each one word further away
        chain[2 * k] = f"c{k}"
        docs.append((1000 + k, " ".join(chain)))
    for k in range(40):  # half of the words
        docs.append((2000 + k, " ".join(words_of[:30] + [f"y{k}_{j}" for j in range(30)])))
    dealt, made = jaccard._dealt, []
    monkeypatch.setattr(jaccard, "_dealt", lambda *a: made.append(dealt(*a)) or made[-1])
    rows = jaccard.join(docs_of(docs), 5, 80, 32).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert [got[i] for i, _ in docs] == brute(docs, 5, 80)
    sizes = [r["count"] for r in made[0].groupBy("task").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 100


def test_edge_rows(spark, docs_of):
    text = " ".join(f"w{k}" for k in range(30))
    docs = docs_of([(None, text), (None, text), (7, text), (7, text), (7, "other words here"), (3, text + " w"), (9, None)])
    rows = sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in jaccard.digest(docs).collect())
    assert rows == sorted(
        map(str, [(None, 28, 3), (None, 28, 3), (7, 28, 3), (7, 28, 3), (7, 1, 7), (3, 29, 3), (9, 0, 9)])
    )
    kept = jaccard.keep_first(docs)
    assert kept.schema == docs.schema
    assert sorted(str((r["doc_id"], len(r["text"] or ""))) for r in kept.collect()) == sorted(
        map(str, [(3, len(text) + 2), (7, len("other words here")), (9, 0)])
    )


def test_one_row_of_each_group_stays(spark, docs_of):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    docs = docs_of(
        # no row of the group has an id
        [(None, text(1)), (None, text(1)), (None, text(1) + " w"), (None, text(2))]
        # a row that came in twice, alone and beside a near copy
        + [(4, text(3)), (4, text(3)), (5, text(4)), (5, text(4)), (6, text(4) + " w")]
        # texts of one id that do not link
        + [(7, text(5)), (7, text(6)), (8, None), (8, None)]
    )
    other = docs.where("doc_id = 4").limit(1).selectExpr("doc_id", "text", "'de' AS lang", *[f"`{c}`" for c in docs.columns[3:]])
    kept = jaccard.keep_first(docs.union(other))
    assert kept.schema == docs.schema
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    first = min(text(1), text(1) + " w", key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert sorted(got, key=str) == sorted(
        [(None, first), (None, text(2)), (4, text(3)), (5, text(4)), (7, text(5)), (7, text(6)), (8, None), (8, None)], key=str
    )


def test_empty_table(spark, docs_of):
    assert jaccard.digest(docs_of([(1, "x")]).limit(0)).collect() == []


def test_last_comparison_is_of_sizes_that_can_link(spark, docs_of, monkeypatch):
    """Texts of many sizes share a passage whose shingles are keys, as if none were rarer."""
    monkeypatch.setattr(jaccard, "HOT", 4)
    monkeypatch.setattr(jaccard, "_frequencies", lambda classes: np.zeros(1 << jaccard.BITS, np.uint8))
    passage = [f"p{j}" for j in range(60)]
    docs = []
    for k in range(150):
        own = [f"x{k}_{j}" for j in range(int(10 * 1.03**k))]
        docs.append((k, " ".join(passage + own)))
        if k % 10 == 0:
            docs.append((1000 + k, " ".join([*passage, *own[:-1], "z"])))
    last, made = jaccard._last_tasks, []
    monkeypatch.setattr(jaccard, "_last_tasks", lambda *a: made.append(last(*a)) or made[-1])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(docs_of(docs), 3, 90, 8).collect()}
    assert [got[i] for i, _ in docs] == brute(docs, 3, 90)
    # all with all in blocks of 8 would be up to 165 * 21 rows
    assert 0 < made[0].count() < 1800


def test_frequencies_are_those_of_all_shingles(spark):
    text = "b c d e f"
    rows = spark.createDataFrame([(k, "", f"{text} u{k}") for k in range(300)] + [(900, "", None)], "doc_id long, part string, text string")
    classes = rows.mapInArrow(jaccard._classes(3), "doc_id long, part string, n_shingles long, cls long, block int, low binary")
    level = jaccard._frequencies(classes)
    value, _ = jaccard.words.sets(*hashed(text), 3)
    common = [int(level[b]) for b in jaccard._bucket(value)]
    assert len(common) == 3 and set(common) == {round(8 * np.log2(301))}
    assert np.count_nonzero(level == 8) >= 290


def hashed(text):
    import pyarrow as pa

    data, begin, end, row = jaccard.words.spans(pa.array([text]))
    return jaccard.words.hashes(data, begin, end, lower=True), row


def test_a_batch_of_long_texts_takes_little_memory():
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(1000)) for _ in range(750)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(750), pa.int64()), pa.array(texts), pa.array(["p"] * 750)], names=["doc_id", "text", "part"]
    )
    tracemalloc.start()
    rows = sum(b.num_rows for b in jaccard._classes(5)(iter([batch])) if b.column("block").null_count)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 750
    assert peak < 8 * sum(map(len, texts))


def test_parts_of_a_task_do_not_change_its_links(monkeypatch):
    docs = [(k, t) for k, t in enumerate(dict.fromkeys(t for _, t in corpus(random.Random(8), 120)))]
    docs = [d for d in docs if grams(d[1], 5)]
    frame = pd.DataFrame({"cls": [i for i, _ in docs], "text": [t for _, t in docs], "side": 2})
    whole = jaccard._join_task(5, 80)(frame.copy())
    monkeypatch.setattr(jaccard, "PART", 300)
    assert len(whole) and jaccard._join_task(5, 80)(frame.copy()).equals(whole)
