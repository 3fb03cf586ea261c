import random

import numpy as np
import pyarrow as pa
import pytest

from tavola.llm import toxicity


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(1500):
        lang = "ab"[i % 2]
        words = [f"{lang}{rng.randint(0, 300)}" for _ in range(rng.randint(5, 80))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice((f"{lang}foul", f"{lang}vile")) + rng.choice(("", ",", "!"))
        docs.append((i, " ".join(words), lang))
        labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark, rows):
    docs, labels = rows
    return (
        spark.createDataFrame([(*d, "s", 1.0) for d in docs], "doc_id long, text string, lang string, source string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_accuracy(spark, rows, tables):
    import zlib

    got = {r["doc_id"]: r for r in toxicity.fit_and_score(*tables).collect()}
    truth = {i: t for i, _, t in rows[1]}
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())
    held = [i for i, r in got.items() if r["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.97


def test_held_out_labels_are_not_learnt(spark, tables):
    from pyspark.sql import functions as F

    docs, labels = tables
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted(map(tuple, toxicity.fit_and_score(docs, x, rows=300).collect())) for x in (labels, turned))
    assert one == two


def test_slopes_are_right():
    rng = np.random.default_rng(0)
    place, row, label = rng.integers(0, 9, 40), np.repeat(np.arange(4), 10), np.array([0.0, 1, 1, 0])
    net = toxicity._train(place, row, label, 8, 1, epochs=1)

    def loss():
        texts = []
        for k in range(4):  # the windows of each text alone
            v = net.embedding[np.append(place[row == k], [0] * max(toxicity.WIDTHS))]
            pooled = []
            for w, kernel, bias in zip(toxicity.WIDTHS, net.filters, net.bias):
                n = len(v) - w + 1
                response = sum(v[j : j + n] @ kernel[j] for j in range(w)) + bias
                pooled.append(np.maximum(response.max(axis=0), 0))
            texts.append(np.concatenate(pooled))
        p = 1 / (1 + np.exp(-(np.array(texts) @ net.out + net.out_bias)))
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p)) + 0.5e-5 * (net.embedding**2).sum()

    slopes = toxicity._slopes(net, place, row, label)
    for part, slope in zip(net.parts(), slopes):
        flat, told = part.reshape(-1), slope.reshape(-1)
        for k in rng.choice(len(flat), min(8, len(flat)), replace=False):
            if part is net.embedding and k < part.shape[1]:
                continue
            old = flat[k]
            flat[k] = old + 1e-6
            up = loss()
            flat[k] = old - 1e-6
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-6 - told[k]) < 1e-5


def test_edge_rows(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels, ~toxicity.held_out(), rows=300)
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "!!!"), (2, "afoul " * 50_000)], "doc_id long, text string")
    got = toxicity.score(odd, model).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert toxicity.score(odd.limit(0), model).collect() == []
    assert {r["score"] for r in toxicity.score(odd, None).collect()} == {0.0}
    assert toxicity.fit(docs, labels.limit(0), ~toxicity.held_out()) is None


def test_one_row_of_a_repeated_id_is_learnt(spark, tables, monkeypatch):
    docs, labels = tables
    learnt = []
    slopes = toxicity._train
    monkeypatch.setattr(toxicity, "_train", lambda place, row, label, *a: learnt.append(len(label)) or slopes(place, row, label, *a))
    truth = labels.where("doc_id < 400")
    hot = docs.where("doc_id = 7").crossJoin(spark.range(500)).selectExpr("doc_id", "concat(text, ' more ', id) AS text", "lang", "source", "score")
    allowed = toxicity.held_out() | ~toxicity.held_out()
    toxicity.fit(docs, truth, allowed)
    toxicity.fit(docs.union(hot), truth, allowed)
    assert learnt == [320, 320]


def test_scores_are_those_of_a_plain_convolution():
    """Each text alone, filter by filter and window by window; no text sees another."""
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{rng.integers(0, 50)}" for _ in range(rng.integers(0, 9))) for _ in range(40)] + ["", "w1 " * 3000]
    hashed, row = toxicity._hashed(pa.array(texts))
    known = np.unique(hashed)[:40]
    vocabulary = toxicity.Vocabulary(known)
    label = (rng.random(len(texts)) < 0.5).astype(float)
    net = toxicity._train(vocabulary.places(hashed), row, label, len(known), 1, epochs=3)
    model = toxicity.Model(vocabulary, net, rng.random((len(known) + 1, 2)), np.array([0.3, -0.2]))
    got = model.scores(pa.array(texts))
    for k, text in enumerate(texts):
        words = [int(p) for p in vocabulary.places(toxicity._hashed(pa.array([text]))[0])]
        vectors = [net.embedding[p] for p in words] + [net.embedding[0]] * max(toxicity.WIDTHS)
        pooled = []
        for w, kernel, bias in zip(toxicity.WIDTHS, net.filters, net.bias):
            for f in range(kernel.shape[2]):
                windows = range(len(vectors) - w + 1)
                best = max(sum(float(vectors[at + j] @ kernel[j, :, f]) for j in range(w)) for at in windows)
                pooled.append(max(best + bias[f], 0.0))
        votes = sum((model.languages[p] for p in words), np.zeros(2))
        odds = float(np.dot(pooled, net.out) + net.out_bias[0]) - model.shift[int(np.argmax(votes))]
        assert got[k] == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-5)


@pytest.fixture(scope="module")
def many_kinds(spark):
    """Toxic texts have one of 40 words; a start of 30 rows holds a few of these only."""
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(2400):
        toxic = int(i % 3 == 0)
        words = [f"w{rng.randint(0, 200)}" for _ in range(rng.randint(10, 30))]
        if toxic:
            words[rng.randrange(len(words))] = f"bad{rng.randrange(40)}"
        docs.append((i, " ".join(words), "a"))
        labels.append((i, 1, toxic))
    return (
        docs, labels,
        spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_all_rows_are_learnt_not_only_those_of_the_start(many_kinds):
    _, labels, docs, table = many_kinds
    truth = {i: t for i, _, t in labels}
    got = toxicity.fit_and_score(docs, table, rows=30).where("held_out").collect()
    caught = [r["predicted"] for r in got if truth[r["doc_id"]]]
    assert np.mean(caught) > 0.8
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in got]) > 0.9


def test_words_and_thresholds_come_from_all_rows(spark, many_kinds):
    from collections import Counter

    docs, labels, table, marks = many_kinds
    toxic = [d for d, (_, _, t) in zip(docs, labels) if t]
    training = toxicity._training(table, marks, toxicity.F.lit(True))
    known, counts = toxicity._known(training, len(toxic), len(docs) - len(toxic))
    all_words, met = Counter(), Counter()
    for _, text, _ in docs:
        all_words.update(text.split())
        met.update(set(text.split()))
    hash_of = {w: int(toxicity._hashed(pa.array([w]))[0][0]) for w in met}
    assert set(known.tolist()) == {hash_of[w] for w, n in met.items() if n >= 3}
    told = {h & (2**64 - 1): n for h, n in zip(counts["hash"].to_pylist(), counts["n"].to_pylist())}
    assert told == {hash_of[w]: n for w, n in all_words.items() if met[w] >= 3}
    assert [r["aside"] for r in training.orderBy("doc_id").collect()].count(True) == len(docs) // 5

    model = toxicity.fit(table, marks, toxicity.F.lit(True), rows=30)
    aside = {r["doc_id"] for r in training.where("aside").collect()}
    texts = [(text, t) for (i, text, _), (_, _, t) in zip(docs, labels) if i in aside]
    hashed, row = toxicity._hashed(pa.array([t for t, _ in texts]))
    odds = model.odds(model.vocabulary.places(hashed), row, len(texts))
    truth = np.array([t for _, t in texts])

    def f1(border):
        said = odds >= border
        return 2 * (said & (truth == 1)).sum() / (said.sum() + truth.sum())

    assert f1(model.shift[0]) >= max(f1(x) for x in odds) - 1e-9


def test_texts_without_words_and_rows_all_aside(spark):
    docs = spark.createDataFrame([(k, (None, "", "!")[k % 3], None) for k in range(12)], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(k, 1, k % 2) for k in range(12)], "doc_id long, quality int, toxic int")
    for allowed in ("true", "doc_id in (4, 8)"):  # 4 and 8 are kept aside
        model = toxicity.fit(docs, marks, toxicity.F.expr(allowed))
        got = toxicity.score(docs, model).collect() if model else []
        assert all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.fit(docs, marks, toxicity.F.expr("doc_id = 4")) is None
