"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pretoken the last token of its encoding is unique. An automaton over the
vocabulary names all tokens that end at a place; the one whose predecessor, the last token of
the prefix before it, is compatible with it is the last token there. Two tokens are compatible
when the merges would leave the border between them alone. Following the last tokens back from
the end gives the ids, in time linear in the text.

Rows: a missing text is an empty one, with no ids. Repeated rows are encoded alike, other
columns are not read, and an empty table gives an empty result. A special token's string in a
text is that token. The memory for a long text is in proportion to its length.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from tavola.llm.pieces import PieceIds, expand, texts_and_ids
from tavola.llm.resident import give_back, resident

SCHEMA = "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(plain)))
    return [letters[b] for b in range(256)]


class Encoder:
    """A byte-level vocabulary with its merges, and the automaton over its tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.ends = np.cumsum([len(b) for b in self.bytes])
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        #: rank of a pair of ids; the pair and rank that made an id (none for single bytes)
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[tuple[int, int, int] | None] = [None] * size
        for rank, (a, b) in enumerate(merges):
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            self.rank.setdefault(pair, rank)
            if self.made[whole] is None:
                self.made[whole] = (*pair, rank)
        self.good: dict[int, bool] = {}
        self.width = size
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if self._stands(i):
                text = self.bytes[i].decode("latin-1")
                self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()

    def _stands(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as the token."""
        made = self.made[token]
        if made is None:
            return len(self.bytes[token]) == 1
        left, right, rank = made
        return self._stands(left) and self._stands(right) and self._meet(left, right, rank)

    def _meet(self, left: int, right: int, until: float = float("inf")) -> bool:
        """Whether the merges of rank below ``until`` leave the border of two tokens alone.

        Undo merges from the latest: while a side is in parts, a pair across the border that
        merges before the side is whole would have been taken first. Of merges of one rank the
        left one is first.
        """
        while True:
            across = self.rank.get((left, right))
            if across is not None and across < until:
                return False
            made_left, made_right = self.made[left], self.made[right]
            rank_left = made_left[2] if made_left else -1
            rank_right = made_right[2] if made_right else -1
            if rank_left < 0 and rank_right < 0:
                return True
            if rank_left > rank_right:
                # the parts of the left side meet the border until just before its merge
                until, left = rank_left, made_left[1]
            else:
                # a pair across the border of equal rank stands further left and goes first
                until, right = rank_right + 1, made_right[0]

    def pretoken(self, text: str) -> list[int]:
        """Ids of one pretoken, given as one character per byte."""
        n = len(text)
        last: list[int] = [-1] * n
        good, width = self.good, self.width
        for end, (size, token) in self.automaton.iter(text):
            if last[end] >= 0:
                continue  # the last token of a prefix is unique
            start = end - size
            if start < 0:
                last[end] = token
            else:
                before = last[start]
                key = before * width + token
                fits = good.get(key)
                if fits is None:
                    if len(good) > 2_000_000:
                        good.clear()
                    fits = good[key] = self._meet(before, token)
                if fits:
                    last[end] = token
        out, at = [], n - 1
        while at >= 0:
            out.append(last[at])
            at -= len(self.bytes[last[at]])
        out.reverse()
        return out

    def pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of texts that hold no special token."""
        out = []
        for piece in pieces:
            ids: list[int] = []
            for part in _PRETOKEN.findall(piece.decode()):
                ids += self.pretoken(part.encode().decode("latin-1"))
            out.append(ids)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, as UTF-8 with what is malformed replaced."""
        whole = self.flat[expand((self.ends - np.diff(self.ends, prepend=0))[ids], self.ends[ids])]
        return whole.tobytes().decode("utf-8", "replace").encode()


#: How byte-level vocabularies of this kind split a text before merging (fixed value).
_PRETOKEN = regex.compile(public_tokenizers.PATTERN)


def cut(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts of texts at places where a pretoken ends for certain.

    Before a space that a visible character follows; around a line feed between visible ASCII
    characters; before a full stop or comma after an ASCII letter or digit and before a blank.
    """
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[ends] = True
    if n:
        edge[0] = True
        visible = (data > 32) & (data < 127)
        # the first byte of a character that is no white space
        opens = visible | ((data >= 0xC3) & (data <= 0xDF)) | (data >= 0xE4)
        blank = (data == 32) | (data == 10)
        same = ~edge[1:n]  # both bytes are of one text
        edge[: n - 1] |= (data[:-1] == 32) & opens[1:] & same
        if n > 2:
            line = (data[1:-1] == 10) & visible[:-2] & visible[2:] & same[:-1] & same[1:]
            edge[1 : n - 1] |= line
            edge[2:n] |= line
            lower = data | 32
            named = ((lower >= 97) & (lower <= 122)) | ((data >= 48) & (data <= 57))
            stop = ((data[1:-1] == 46) | (data[1:-1] == 44)) & named[:-2] & blank[2:]
            edge[1 : n - 1] |= stop & same[:-1] & same[1:]
    edge[n] = False
    first = np.flatnonzero(edge[:n])
    # an empty text has its edge where the next one begins, so no piece is empty
    return data, np.append(first[1:], n) if len(first) else first, np.searchsorted(ends, first, side="right")


def _encoder(path: str) -> tuple[Encoder, PieceIds]:
    def build() -> tuple[Encoder, PieceIds]:
        encoder = Encoder(path)
        return encoder, PieceIds(encoder.pieces)

    return resident(("bpe", path), build)


def encode_texts(texts: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray]]:
    """Row and ids of each text; the texts with special tokens come last."""
    encoder, known = _encoder(path)
    special = regex.compile("|".join(map(regex.escape, encoder.special)))
    texts = texts.cast(pa.large_string())
    marked = [
        k for k, has in enumerate(pa.compute.match_substring_regex(texts, special.pattern).to_pylist()) if has
    ]
    plain = texts
    if marked:
        keep = np.ones(len(texts), dtype=bool)
        keep[marked] = False
        plain = pa.compute.if_else(pa.array(keep), texts, pa.scalar("", pa.large_string()))
    skip = set(marked)
    for first, ends, ids in texts_and_ids(plain, cut, known):
        start = 0
        for k, end in enumerate(ends.tolist()):
            if first + k not in skip:
                yield first + k, ids[start:end]
            start = end
    for k in marked:
        text, out, at = texts[k].as_py(), [], 0
        for match in special.finditer(text):
            out += _ids(text[at : match.start()], known) + [encoder.special[match[0]]]
            at = match.end()
        yield k, np.array(out + _ids(text[at:], known), dtype=np.int32)


def _ids(text: str, known: PieceIds) -> list[int]:
    return next(iter(texts_and_ids(pa.array([text]), cut, known)))[2].tolist()


def _coder(path: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                doc_ids = batch.column("doc_id").to_pylist()
                rows = []
                for k, ids in encode_texts(batch.column("text"), path):
                    raw = ids.astype("<u4").tobytes()
                    rows.append((
                        doc_ids[k],
                        len(ids),
                        raw if keep_ids else None,
                        hashlib.sha256(raw).hexdigest(),
                        hashlib.sha256(encoder.decode(ids)).hexdigest(),
                    ))
                columns = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string()))],
                    names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
                )
                give_back()

    return run


def encode_documents(docs: DataFrame, path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit; null unless ``keep_ids``), and the
    SHA-256 of the ids and of the text decoded from them, for every row."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return docs.select("doc_id", "text").mapInArrow(_coder(path, keep_ids), SCHEMA)


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    return encode_documents(docs, path, keep_ids=False).drop("ids")
