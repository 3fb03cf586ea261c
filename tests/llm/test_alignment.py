"""Alignment of two tokenizers against a token-by-token version on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tavola.llm import alignment

COLUMNS = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
LETTERS = "ab  \n\t\r.,'s'tre!?é漢字  　\x1c\x85🙂0123ABIİ́-_*# ​\x00ßº×÷"


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(p): p for p in plain}
    letter |= {chr(256 + k): p for k, p in enumerate(p for p in range(256) if p not in plain)}
    return a, b, letter


def _tokens(tokenizers, text):
    a, b, letter = tokenizers
    left = [(i, bytes(letter[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(t for _, t in left) != whole or b"".join(t for _, t in right) != whole:
        return None
    return left, right


def _spans(tokens):
    out, at = [], 0
    for i, token in tokens:
        out.append((i, at, at + len(token)))
        at += len(token)
    return out


def _brute(tokenizers, texts):
    links, groups = [], []
    for text in texts:
        found = _tokens(tokenizers, text) if text else None
        if found is None:
            links.append(None)
            groups.append(None)
            continue
        left, right = map(_spans, found)
        links.append([(i, j) for i, x, y in left for j, u, v in right if x < v and u < y])
        both = {y for _, _, y in left} & {v for _, _, v in right}
        told, start = [], 0
        for end in sorted(both):
            told.append(
                ",".join(str(i) for i, x, y in left if start <= x and y <= end)
                + "|"
                + ",".join(str(j) for j, u, v in right if start <= u and v <= end)
            )
            start = end
        groups.append((len(left), len(right), told))
    count = Counter(pair for some in links if some for pair in some)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for some, group in zip(links, groups):
        if some is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, told = group
        out.append((n_a, n_b, len(told), len(some), sum(count[p] == most[p[1]] for p in some),
                    sum(count[p] for p in some), hashlib.sha256(";".join(told).encode()).hexdigest()))
    return out


def _aligned(docs_of, texts):
    rows = alignment.align_documents(docs_of(list(enumerate(texts)))).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    return [tuple(r[c] for c in COLUMNS) for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_against_brute_force(docs_of, tokenizers):
    rng = random.Random(6)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(1, 60))) for _ in range(250)]
    texts += [" ".join(rng.choice("the of shreer thand été 日本 a. I'll 'tis".split()) for _ in range(40)) for _ in range(60)]
    texts += [None, "", " ", "  ", "\n", "a ", " a", "  a  b  ", "x▁y", "▁", "<s> </s>", "<|endoftext|> a<|endoftext|>", "<0x41>"]
    texts += ["copy of a text"] * 40 + ["日本" * 700, "z" * 900, "1 " * 300, "A  b", "a ▁ b c", "é x"]
    rng.shuffle(texts)
    assert _aligned(docs_of, texts) == _brute(tokenizers, texts)


def test_given_documents(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 1500")
    given = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    rows = sorted(alignment.align_documents(docs).collect(), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == [i for i, _ in given]
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == _brute(tokenizers, [t for _, t in given])


def test_pieces_are_whole_texts_again():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab  é\n　") for _ in range(rng.randrange(1, 12))) for _ in range(500)]
    raw = [t.encode() for t in texts]
    data, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])
    out, piece_ends, row = alignment.cut(data, ends)
    back = [b""] * len(raw)
    start = 0
    for k, end in zip(row.tolist(), piece_ends.tolist()):
        piece = out[start:end].tobytes()
        assert piece.startswith(b" ") and len(piece) > 1
        back[k] += piece
        start = end
    assert back == [b" " + r for r in raw]


def test_little_room_for_pieces_changes_nothing():
    texts = pa.array([f"word{k} and more{k % 7} 漢字{k}" * 3 for k in range(300)])
    copies = np.arange(300)
    tokenizers = alignment.Tokenizers(*(public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    assert tokenizers.parted
    known, small = alignment.Aligned(tokenizers), alignment.Aligned(tokenizers, 100)
    whole = alignment.align_texts(known, texts, copies)
    for k in range(0, 300, 50):
        part = alignment.align_texts(small, texts.slice(k, 50), copies[k : k + 50])
        for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
            assert list(part[name]) == list(whole[name][k : k + 50])
        assert small.held > 100 and len(small.index) < len(known.index)


def test_empty_table(docs_of):
    assert alignment.align_documents(docs_of([])).collect() == []
    assert _aligned(docs_of, [None, ""]) == [(0, 0, 0, 0, 0, 0, "")] * 2
