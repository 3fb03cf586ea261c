"""Alignment of the tokens of two tokenizers, each distinct text once.

1. *Distinct texts.* Rows are shuffled by their full text, after each task has counted its own
   copies, so a text that a third of all rows repeat is one row of each task.
2. *Tokens and links.* Each distinct text is encoded by both tokenizers and aligned over its
   bytes. Every stretch between two neighbouring token ends, of either side, is one link: that
   of the two tokens that cover it. Where tokens of both sides end together a group ends.
3. *Counts.* The links of an id pair, times the copies of their texts, are summed over the corpus.
4. *Measures* of the texts come from the counts of the pairs they hold. A task's texts are laid
   down in blocks with their distinct pairs; a block asks for the counts of its own pairs, so no
   task holds the table of counts, and a pair that all texts hold is one row for each block.
5. *Rows* get the measures of their text by its 128-bit key.

Both tokenizers treat the two sides of a single space apart (checked when the vocabulary is
read), so a text is cut there and each piece is encoded and aligned once for a task; the cuts
are ends of tokens on both sides.

Rows: a missing or empty text, and one whose tokens do not give its bytes again (a text with
U+2581), has no tokens: zeros, and an empty string for the digest; its links count nowhere.
Repeated rows have equal measures and each counts. Other columns are not read, and an empty
table gives an empty result. A long text needs memory in proportion to its length.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tavola.llm.bpe import byte_letters
from tavola.llm.pieces import expand
from tavola.llm.resident import resident
from tavola.llm.shared import stored
from tavola.llm.tables import text_key
from tavola.llm.words import text_slices

#: Bytes of pieces and of what is known of them that a worker keeps, and of the texts of a block.
KEPT, BLOCK = 48_000_000, 2_000_000
#: Pieces that are encoded at a time.
BATCH = 5000
#: A pair is one number: the id of the first tokenizer times this, plus that of the second.
SIDE = 1 << 32

_MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_BLOCKS = (
    "block string, texts array<struct<key: string, n_a: long, n_b: long, n_groups: long, "
    "n_links: long, groups_sha256: string>>, pairs array<long>, weights array<long>, "
    "ends array<int>, at array<int>, times array<int>"
)


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str) -> None:
        # one thread for each task: Spark's tasks share the cores, and threads keep memory each
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.bytes_a = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if token not in special else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.bytes_b.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.bytes_b.append(piece.replace("▁", " ").encode())
        self.size_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.size_b = np.array([len(b) for b in self.bytes_b], np.int64)
        # the pattern of byte-level vocabularies puts a single space with the word behind it
        pattern = spec.get("pre_tokenizer") or {}
        by_pattern = pattern.get("type") == "ByteLevel" and pattern.get("use_regex") and not spec.get("normalizer")
        #: whether no token of either side goes on over a single space between characters
        self.parted = bool(by_pattern) and not any(b" " in b.lstrip(b" ") for b in self.bytes_b)

    def encode(self, pieces: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides of pieces that begin with a space, which the second one adds itself."""
        texts = [piece.decode() for piece in pieces]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([text[1:] for text in texts], num_threads=1)
        return a, b


class Aligned:
    """Tokens, groups and links of pieces; emptied when it holds more than ``most`` bytes."""

    def __init__(self, tokenizers: Tokenizers, most: int = KEPT) -> None:
        self.tokenizers, self.most = tokenizers, most
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.n_a, self.n_b, self.n_groups = array("q"), array("q"), array("q")
        self.bad = array("b")
        self.groups: list[bytes] = []
        self.links, self.ends = array("q"), array("q", [0])
        self.held = 0

    def find(self, pieces: list[bytes]) -> np.ndarray:
        """The places of ``pieces``, all of which are known then."""
        if self.held > self.most:
            self.clear()
        new = [p for p in pieces if p not in self.index]
        for at in range(0, len(new), BATCH):
            self._learn(new[at : at + BATCH])
        return np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))

    def _learn(self, pieces: list[bytes]) -> None:
        t = self.tokenizers
        a, b = t.encode(pieces)
        for k, piece in enumerate(pieces):
            fits = (
                b"".join(map(t.bytes_b.__getitem__, b[k])) == piece
                and b"".join(map(t.bytes_a.__getitem__, a[k])) == piece
            )
            self.index[piece] = len(self.bad)
            self.bad.append(not fits)
            if not fits:
                a[k], b[k] = [], []
            self.held += 250 + 2 * len(piece)
        self.n_a.extend(map(len, a))
        self.n_b.extend(map(len, b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a, b))
        ends_a, ends_b = np.cumsum(t.size_a[flat_a]), np.cumsum(t.size_b[flat_b])
        # each stretch between neighbouring ends is covered by one token of either side
        edges = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, edges), np.searchsorted(ends_b, edges)
        of_a = np.repeat(np.arange(len(pieces)), [len(ids) for ids in a])
        n_links = np.bincount(of_a[at_a], minlength=len(pieces))
        self.links.frombytes((flat_a[at_a] * SIDE + flat_b[at_b]).astype(np.int64).tobytes())
        self.ends.frombytes((self.ends[-1] + np.cumsum(n_links)).astype(np.int64).tobytes())
        self.held += 8 * len(edges)
        both = np.flatnonzero((ends_a[at_a] == edges) & (ends_b[at_b] == edges))
        n_groups = np.bincount(of_a[at_a[both]], minlength=len(pieces))
        self.n_groups.frombytes(n_groups.astype(np.int64).tobytes())
        text_a, text_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        told, x, y = [], 0, 0
        for u, v in zip((at_a[both] + 1).tolist(), (at_b[both] + 1).tolist()):
            told.append(",".join(text_a[x:u]) + "|" + ",".join(text_b[y:v]))
            x, y = u, v
        k = 0
        for n in n_groups.tolist():
            group = ";".join(told[k : k + n]).encode()
            self.groups.append(group)
            self.held += len(group)
            k += n


def cut(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of bytes ``data`` that end at ``ends``, cut before single spaces between characters.

    The bytes of the pieces one after another, each with a space first; the ends of the pieces;
    and the text of each. A space is added before each text, the others are the texts' own.
    """
    n = len(data)
    begins = np.concatenate([[0], ends[:-1]])
    edge = np.zeros(n, dtype=bool)
    # the first byte of a character that is no white space
    opens = ((data > 32) & (data < 127)) | ((data >= 0xC3) & (data <= 0xDF)) | (data >= 0xE4)
    if n > 2:
        edge[1:-1] = (data[1:-1] == 32) & (data[:-2] != 32) & opens[2:]
    inside = begins[begins < n]
    edge[inside] = False  # the first byte of a text follows the added space
    edge[ends[(ends > 0) & (ends <= n)] - 1] = False  # the last one is followed by another text
    # bytes with the added spaces; no text is empty
    out = np.full(n + len(ends), 32, dtype=np.uint8)
    text = np.repeat(np.arange(len(ends)), ends - begins)
    out[np.arange(n) + text + 1] = data
    cuts = np.flatnonzero(edge)
    first = np.sort(np.concatenate([begins + np.arange(len(ends)), cuts + text[cuts] + 1]))
    piece_ends = np.append(first[1:], len(out))
    row = np.searchsorted(ends + np.arange(1, len(ends) + 1), first, side="right")
    return out, piece_ends, row


def _whole(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``cut``, each text as one piece."""
    out = np.full(len(data) + len(ends), 32, dtype=np.uint8)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    out[np.arange(len(data)) + text + 1] = data
    return out, ends + np.arange(1, len(ends) + 1), np.arange(len(ends))


def align_texts(known: Aligned, texts: pa.Array, copies: np.ndarray) -> dict:
    """Measures and links of non-empty ``texts``, of which there are ``copies`` each.

    For each text n_a, n_b, n_groups, n_links and groups_sha256; the distinct pairs and their
    links in all copies; and for each text, up to ``ends``, the places ``at`` of its pairs among
    those and its own links (``times``).
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    split = cut if known.tokenizers.parted else _whole
    data, ends, row = split(data, offsets[1:] - offsets[0])
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(ends),
        [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(data)],
    ).dictionary_encode()
    place = known.find(pieces.dictionary.to_pylist())[pieces.indices.to_numpy(zero_copy_only=False)]
    n = len(texts)

    def total(values: array) -> np.ndarray:
        return np.bincount(row, weights=np.array(values)[place], minlength=n).astype(np.int64)

    good = total(known.bad) == 0
    here = good[row]
    of_piece = place[here]
    link_ends = np.array(known.ends)
    low, high = link_ends[of_piece], link_ends[of_piece + 1]
    link = np.array(known.links)[expand(low, high)]
    of_link = np.repeat(row[here], high - low)
    pairs, code = np.unique(link, return_inverse=True)
    held, times = np.unique(of_link * max(len(pairs), 1) + code, return_counts=True)
    text, at = held // max(len(pairs), 1), held % max(len(pairs), 1)
    weights = np.zeros(len(pairs), np.int64)
    np.add.at(weights, at, times * copies[text])
    measures = {name: total(getattr(known, name)) * good for name in ("n_a", "n_b", "n_groups")}
    measures["n_links"] = np.bincount(of_link, minlength=n)
    bounds = np.searchsorted(row, np.arange(n + 1)).tolist()
    groups, where = known.groups, place.tolist()
    measures["groups_sha256"] = [
        hashlib.sha256(b";".join([groups[p] for p in where[bounds[k] : bounds[k + 1]]])).hexdigest() if good[k] else ""
        for k in range(n)
    ]
    text_ends = np.cumsum(np.bincount(text, minlength=n))
    return measures | {"pairs": pairs, "weights": weights, "ends": text_ends, "at": at, "times": times}


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _blocks(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = resident(("alignment", path_a, path_b), lambda: Aligned(Tokenizers(path_a, path_b)))
        for batch in batches:
            copies = batch.column("copies").to_numpy()
            for first, texts in text_slices(batch.column("text"), BLOCK):
                n = len(texts)
                found = align_texts(known, texts, copies[first : first + n])
                rows = pa.StructArray.from_arrays(
                    [
                        batch.column("key").slice(first, n),
                        *[pa.array(found[name], pa.int64()) for name in _MEASURES],
                        pa.array(found["groups_sha256"], pa.string()),
                    ],
                    names=["key", *_MEASURES, "groups_sha256"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uuid.uuid4().hex]),
                        pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows),
                        _lists(found["pairs"], pa.int64()),
                        _lists(found["weights"], pa.int64()),
                        *[_lists(found[name], pa.int32()) for name in ("ends", "at", "times")],
                    ],
                    names=["block", "texts", "pairs", "weights", "ends", "at", "times"],
                )

    return run


_DONE = "key string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks and the counts of their pairs: a row for each text."""
    for batch in batches:
        for k in range(batch.num_rows):
            texts = batch.column("texts")[k].values
            ends, at, times = (batch.column(c)[k].values.to_numpy() for c in ("ends", "at", "times"))
            count, best = np.zeros(len(batch.column("pairs")[k]), np.int64), np.zeros(len(batch.column("pairs")[k]), np.int64)
            answers = batch.column("answers")[k].values
            if answers is not None:
                nth = answers.field("nth").to_numpy()
                count[nth] = answers.field("n").to_numpy()
                best[nth] = answers.field("best").to_numpy()
            zero = np.zeros(1, np.int64)
            sums = np.concatenate([zero, np.cumsum(times * count[at])])
            bests = np.concatenate([zero, np.cumsum(times * best[at])])
            begins = np.concatenate([zero, ends[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    texts.field("key"),
                    *[texts.field(name) for name in _MEASURES],
                    pa.array(bests[ends] - bests[begins]),
                    pa.array(sums[ends] - sums[begins]),
                    texts.field("groups_sha256"),
                ],
                names=["key", *_MEASURES, "n_best", "count_sum", "groups_sha256"],
            )


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (ids of both sides), n (links in the corpus) and best (1 where no pair of the same
    second id has more links, else 0)."""
    pair = F.arrays_zip("pairs", "weights")
    counts = (
        blocks.select(F.explode(pair).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.weights").alias("n"))
        .withColumn("b", F.col("pair") % SIDE)
    )
    counts = stored(counts, "counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def aligned_texts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """key and measures of each distinct text that is not empty."""
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    distinct = docs.where("length(text) > 0").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    keyed = distinct.select(text_key().alias("key"), "text", "copies")
    blocks = stored(keyed.mapInArrow(_blocks(path_a, path_b), _BLOCKS), "blocks")
    asked = blocks.select("block", F.posexplode("pairs").alias("nth", "pair"))
    # as many answers as the texts of one block have pairs
    answers = (
        asked.join(pair_counts(blocks), "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct("nth", "n", "best")).alias("answers"))
    )
    asking = blocks.drop("weights").join(answers, "block", "left")
    # written apart, so that a text of very many rows can be split in the join
    return stored(asking.mapInArrow(_measure, _DONE), "measures")


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measures = aligned_texts(rows, path_a, path_b)
    keyed = rows.select("doc_id", text_key().alias("key"))
    zero = F.lit(0).cast("long")
    return keyed.join(measures, "key", "left").select(
        "doc_id",
        *[F.coalesce(c, zero).alias(c) for c in (*_MEASURES, "n_best", "count_sum")],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
