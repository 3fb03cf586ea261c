"""Ids of many texts from the ids of their distinct pieces.

A tokenizer that treats the parts of a text on the two sides of a cut apart needs to see each
distinct piece between cuts only once. The functions here cut a batch of texts, find the
distinct pieces, look up or make their ids, and put the ids of the texts together; all but the
making is array work. A worker keeps the ids of ``most`` pieces at a time.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from tavola.llm.words import text_slices


class PieceIds:
    """Ids of pieces by their bytes; emptied before a part when it holds ``most`` pieces."""

    def __init__(self, make: Callable[[list[bytes]], list[list[int]]], most: int = 500_000) -> None:
        self.make, self.most = make, most
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids, self.ends = array("i"), array("q", [0])

    def find(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end place in an array of ids, for each of the distinct ``pieces``."""
        if len(self.index) > self.most:
            self.clear()
        new = [p for p in pieces if p not in self.index]
        for piece, ids in zip(new, self.make(new)):
            self.index[piece] = len(self.index)
            self.ids.extend(ids)
            self.ends.append(len(self.ids))
        at = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        ends = np.array(self.ends, dtype=np.int64)
        return ends[at], ends[at + 1], np.array(self.ids, dtype=np.int32)


def expand(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The places first[0]..end[0]-1, first[1]..end[1]-1, ..."""
    size = end - first
    total = np.cumsum(size)
    if not len(size) or not total[-1]:
        return np.zeros(0, np.int64)
    return np.arange(total[-1], dtype=np.int64) + np.repeat(first - (total - size), size)


def texts_and_ids(
    texts: pa.Array,
    cut: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
    known: PieceIds,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For parts of ``texts``: their first row, the ends of the rows' ids, and the ids.

    ``cut`` takes the bytes of a part and the ends of its texts and gives the bytes of the
    pieces one after another, the pieces' ends, and the row of each piece.
    """
    for first, part in text_slices(texts):
        part = part.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        body = part.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        data, ends = data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]
        pieces, piece_ends, row = cut(data, ends)
        strings = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(piece_ends),
            [None, pa.py_buffer(np.concatenate([[0], piece_ends]).astype(np.int64)), pa.py_buffer(pieces)],
        )
        coded = strings.dictionary_encode()
        a, b, ids = known.find(coded.dictionary.to_pylist())
        code = coded.indices.to_numpy(zero_copy_only=False)
        a, b = a[code], b[code]
        sizes = np.bincount(row, weights=b - a, minlength=len(part)).astype(np.int64)
        yield first, np.cumsum(sizes), ids[expand(a, b)]
