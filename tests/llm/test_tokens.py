"""Token files and byte-pair encoding against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tavola.llm import bpe, token_files

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LETTERS = "ab  \n\t\r.,'s'tre!?é漢字  　\x1c\x85🙂0123ABIİ́-_*# ​\x00J̌ßºª×÷"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    out += ["".join(rng.choice("theaoinrs ,.") for _ in range(300)) for _ in range(300)]
    out += ["", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>\n\n c", "x" * 20_000, " " * 3000 + "y", "\n\n\n"]
    out += ["it's we'll'd  . ,a ., a,, .", "A.B, c", "The end. The end, the END.\nNext line."]
    return out


def test_pieces_give_the_ids_of_the_library(texts):
    library = Tokenizer.from_file(WORD)
    got = [ids.tolist() for ids in token_files.encode_texts(pa.array(texts), WORD)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_prefixes_give_the_ids_of_the_library(texts):
    library = Tokenizer.from_file(BYTE)
    encoder, _ = bpe._encoder(BYTE)
    got = dict(bpe.encode_texts(pa.array(texts), BYTE))
    for k, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert got[k].tolist() == e.ids, texts[k]
        assert encoder.decode(got[k]).decode() == library.decode(e.ids, skip_special_tokens=False)


def test_last_tokens_of_all_prefixes(texts):
    encoder, _ = bpe._encoder(BYTE)
    library = Tokenizer.from_file(BYTE)
    for word in ("abracadabra", " institutionalization", "aaaaaaaaaaaaaaa", " hehehehhe"):
        for k in range(1, len(word) + 1):
            assert encoder.pretoken(word[:k]) == library.encode(word[:k], add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs():
    return [(5, "The end."), (-3, None), (None, "no id"), (7, ""), (2, "a b c " * 3000), (2, "A second two"), (9, "été, 漢字")]


def test_token_files_round_trip(spark, docs_of, docs, tmp_path):
    library = Tokenizer.from_file(WORD)
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    expected, start, run = [], 0, []
    for i, text in ordered:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        run += ids
    frame = docs_of(docs)
    rows = token_files.round_trip(frame, length=16).collect()
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=str) == sorted(expected, key=str)
    folder = f"file://{tmp_path}/t"
    manifest = sorted(token_files.write_tokens(frame, folder, length=16).collect(), key=lambda r: r["shard"])
    read = []
    for entry in manifest:
        shard = token_files.Sequences(folder, entry["tokens_path"], entry["batches"])
        for k in range(-(-entry["n_tokens"] // 16)):
            ids, mask = shard.sequence(k)
            assert len(ids) == len(mask) == 16
            read += ids[mask].tolist()
        with pa.memory_map(entry["tokens_path"]) as source:
            assert sum(b.num_rows for b in pa.ipc.open_stream(source)) == -(-entry["n_tokens"] // 16)
    assert read == run


def test_documents_are_encoded(spark, docs_of, docs):
    library = Tokenizer.from_file(BYTE)
    rows = bpe.encode_documents(docs_of(docs)).collect()
    expected = []
    for i, text in docs:
        raw = np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()
        expected.append((i, len(raw) // 4, raw, hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = [(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_empty_tables(spark, docs_of):
    none = docs_of([(1, "x")]).limit(0)
    assert bpe.digest(none).collect() == [] and token_files.round_trip(none).collect() == []
