"""Words, word hashes and shingles of Arrow texts, whole batches at a time in numpy.

A word is a run of bytes other than the six ASCII white-space characters. Word hashes are
64-bit sums of random byte codes times powers of an odd number; they are computed in blocks
of a few megabytes, so that a very long text needs memory in proportion to its words only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_POWER = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 21
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _byte_codes(lower: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _POWER)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def text_slices(texts: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of about ``most`` bytes, one text at least, with their first row."""
    if not len(texts):
        return
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, texts.slice(first, last - first)
        first = last


def _only_letters() -> np.ndarray:
    kept = np.arange(256, dtype=np.uint8)
    for b in range(128):
        if not chr(b).isalnum():
            kept[b] = 32
    return kept


def spans(
    texts: pa.Array, letters: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts, first and end byte of each word, and the row of each word.

    With ``letters`` all ASCII characters but letters and digits divide words.
    """
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    data = data[ends[0] : ends[-1]]
    ends = ends - ends[0]
    if letters:
        data = _only_letters()[data]
    blank = np.ones(len(data) + 1, dtype=bool)
    np.logical_or(data == 32, (data >= 9) & (data <= 13), out=blank[: len(data)])
    starts_word = ~blank[:-1]
    after_blank = np.empty(len(data), dtype=bool)
    if len(data):
        after_blank[0] = True
        after_blank[1:] = blank[:-2]
        cuts = ends[:-1][ends[:-1] < len(data)]
        after_blank[cuts] = True
    ends_word = starts_word.copy()
    if len(data):
        ends_word[:-1] &= after_blank[1:] | blank[1:-1]
    first = np.flatnonzero(starts_word & after_blank)
    end = np.flatnonzero(ends_word) + 1
    row = np.searchsorted(ends, first, side="right") - 1
    return data, first, end, row


def hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word, of its bytes with A-Z lowered if ``lower``."""
    out = np.empty(len(first), dtype=np.uint64)
    codes = _byte_codes(lower)
    at = 0
    while at < len(first):
        base = first[at]
        to = max(at + 1, int(np.searchsorted(first, base + _BLOCK)))
        size = int(end[to - 1] - base)
        powers = np.full(size + 1, _POWER, dtype=np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(codes[data[base : base + size]] * powers[:size], out=sums[1:])
        a, b = first[at:to] - base, end[at:to] - base
        # the sum times the power that is missing up to the end of the block is free of the place
        out[at:to] = (sums[b] - sums[a]) * powers[size - a]
        # divide out the block's length: multiply by the inverse power
        out[at:to] *= _inverse_power(size)
        at = to
    return mix(out)


def _inverse_power(n: int) -> np.uint64:
    return np.uint64(pow(pow(int(_POWER), -1, 1 << 64), n, 1 << 64))


_FACTORS = mix(np.arange(101, 133, dtype=np.uint64)) | np.uint64(1)


def shingles(hashed: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every ``n`` words in turn; a row of fewer words is one shingle."""
    if not len(hashed):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows, start, count = np.unique(row, return_index=True, return_counts=True)
    total = np.zeros(len(hashed), dtype=np.uint64)
    for k in range(min(n, len(hashed))):
        total[: len(hashed) - k] += hashed[k:] * _FACTORS[k]
    inside = np.zeros(len(hashed), dtype=bool)
    if len(hashed) >= n:
        inside[: len(hashed) - n + 1] = row[: len(hashed) - n + 1] == row[n - 1 :]
    out, of = mix(total[inside]), row[inside]
    short = count < n
    if short.any():
        extra = np.zeros(int(short.sum()), dtype=np.uint64)
        for c in range(1, n):
            of_c = count[short] == c
            at = start[short][of_c]
            total_c = np.full(len(at), c, dtype=np.uint64) * _FACTORS[31]
            for k in range(c):
                total_c += hashed[at + k] * _FACTORS[k]
            extra[of_c] = total_c
        out, of = np.concatenate([out, mix(extra)]), np.concatenate([of, rows[short]])
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
    return out, of


def sets(hashed: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row in ascending order, and their rows."""
    value, of = shingles(hashed, row, n)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    if len(value):
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
        value, of = value[new], of[new]
    return value, of
