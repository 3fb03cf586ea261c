"""The stages against plain Python on small tables."""

import random

import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline


@pytest.fixture()
def small(folder):
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(4000)]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [line(30) for _ in range(3)]
    passage = line(70)
    near = line(200).split(" ")
    texts = {i: line(80) for i in range(10)}
    texts[10] = "too short"
    texts[11] = "# $ % & " * 30
    texts[12] = f"{line(60)}\n{passage}"
    texts[13] = f"{passage}\n{line(60)}"
    texts[14] = " ".join(near)
    texts[15] = " ".join(near[:100] + ["changed"] + near[101:])
    texts[16] = f"{line(50)} {items[1]} {line(40)}"
    texts[17] = texts[3]
    texts[18] = None
    table = pa.table(
        {
            "doc_id": pa.array(list(texts), pa.int64()),
            "text": pa.array(list(texts.values()), pa.string()),
            "lang": ["en"] * len(texts),
            "source": ["s"] * len(texts),
            "n_chars": pa.array([len(t or "") for t in texts.values()], pa.int64()),
            "kept": ["clash"] * len(texts),
        }
    )
    benchmark = pa.table({"item_id": pa.array([0, 1, 2], pa.int64()), "text": items})
    return folder(documents=table, benchmark=benchmark), texts, passage


def test_run(spark, small):
    path, texts, passage = small
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, path).collect()}
    assert sorted(rows) == [*range(10), 12, 13, 14]
    texts[13] = texts[13].split("\n")[1]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in rows.items():
        ids = library.encode(texts[i], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and bytes(r["ids"]) == b"".join(k.to_bytes(4, "little") for k in ids)


def test_stages_keep_the_columns(spark, small):
    path, _, _ = small
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
        assert stage(spark, docs.limit(0), path).collect() == []
