"""Benchmark decontamination: SimHash of item-sized windows, a multi-index, exact similarity.

For each size of benchmark item in words, the windows of that size of every document are
compared with the items of that size; a document shorter than the item is one window. Shingles
are five words with A-Z lowered (all words of a shorter text), weighed by their bytes.

1. Windows without any shingle of an item of their size have similarity 0 and are passed over.
2. The others get a 64-bit SimHash: running sums of weighted signs give all windows of a text.
3. Four blocks of 16 bits: if two fingerprints differ in at most 19 bits, one block differs in at
   most 4. The index lists the items under every value within 4 bits of their block, so that one
   look-up per block finds all items within the radius; whole fingerprints decide.
4. Candidates are confirmed by the exact weighted Jaccard similarity of the distinct shingles.

The index is built for blocks of at most ``BLOCK_BYTES`` of benchmark text, whose size is
measured; a larger benchmark is scanned for block by block. Nothing of the documents leaves
their tasks but what was found.

Rows: missing and empty texts and items match nothing. Repeated rows are found each. An empty
table on either side finds nothing. All columns pass through ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.llm import words
from tavola.llm.pieces import expand
from tavola.llm.resident import give_back

N = 5
RADIUS = 19
BLOCKS, BITS = 4, 16
BLOCK_BYTES = 128 << 10
FOUND = "doc_id long, item_id long, first_word long, n_words long, similarity double, distance int"
#: Places whose running sums are held at a time.
SPAN = 8192
#: Bytes of text whose shingles are held at a time.
PART = 1_000_000


def _shingled(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles with their rows and weights in order, and the number of words of each row."""
    data, begin, end, row = words.spans(texts)
    value, of = words.shingles(words.hashes(data, begin, end, lower=True), row, N)
    n_words = np.bincount(row, minlength=len(texts))
    length = np.concatenate([[0], np.cumsum(end - begin)])
    # the words of a shingle: N, or all of a shorter row
    first_word = np.concatenate([[0], np.cumsum(n_words)])[:-1]
    n_shingles = np.bincount(of, minlength=len(texts))
    place = np.arange(len(of)) - (np.cumsum(n_shingles) - n_shingles)[of]
    a = first_word[of] + place
    return value, of, (length[a + np.minimum(N, n_words[of])] - length[a]).astype(np.int64), n_words


_BIT = np.arange(64, dtype=np.uint64)


def _signs(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    bits = (words.mix(value)[:, None] >> _BIT) & np.uint64(1)
    return np.where(bits == 1, weight[:, None], -weight[:, None]).astype(np.int64)


def _packed(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BIT).sum(axis=1, dtype=np.uint64)


class Index:
    """A block of benchmark items, ready for look-ups."""

    def __init__(self, ids: list, texts: list[str], percent: int) -> None:
        value, of, weight, n_words = _shingled(pa.array(texts, pa.large_string()))
        self.percent = percent
        self.ids, self.n_words = ids, n_words
        self.sets, self.total = [], []
        finger = np.zeros(len(ids), dtype=np.uint64)
        for k in range(len(ids)):
            mine = of == k
            finger[k] = _packed(_signs(value[mine], weight[mine]).sum(axis=0)[None, :])[0]
            distinct, first = np.unique(value[mine], return_index=True)
            self.sets.append(distinct)
            self.total.append(int(weight[mine][first].sum()))
        self.finger = finger
        order = np.argsort(value, kind="stable")
        self.value, start = np.unique(value[order], return_index=True)
        bounds = np.append(start, len(value))
        # sizes, in words, of the items that hold a shingle
        self.sizes = [np.unique(n_words[of[order[a:b]]]) for a, b in zip(bounds[:-1], bounds[1:])]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.value >> np.uint64(44)] = True
        masks = [0] + [
            sum(1 << b for b in bits) for r in range(1, RADIUS // BLOCKS + 1) for bits in combinations(range(BITS), r)
        ]
        masks = np.array(masks, dtype=np.uint64)
        self.tables = []
        usable = np.flatnonzero(n_words > 0)
        for block in range(BLOCKS):
            part = (finger[usable] >> np.uint64(BITS * block)) & np.uint64((1 << BITS) - 1)
            near = (part[:, None] ^ masks).ravel().astype(np.int64)
            item = np.repeat(usable, len(masks))
            by_value = np.argsort(near, kind="stable")
            starts = np.searchsorted(near[by_value], np.arange((1 << BITS) + 1))
            self.tables.append((starts, item[by_value].astype(np.int32)))

    def candidates(self, finger: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of items of the same size within the radius."""
        windows, items = [], []
        for block, (starts, item) in enumerate(self.tables):
            part = ((finger >> np.uint64(BITS * block)) & np.uint64((1 << BITS) - 1)).astype(np.int64)
            a, b = starts[part], starts[part + 1]
            windows.append(np.repeat(np.arange(len(finger)), b - a))
            items.append(item[expand(a, b)])
        pair = np.unique(np.concatenate(windows) * len(self.ids) + np.concatenate(items))
        window, item = pair // max(len(self.ids), 1), pair % max(len(self.ids), 1)
        distance = np.bitwise_count(finger[window] ^ self.finger[item]).astype(np.int64)
        ok = (distance <= RADIUS) & (self.n_words[item] == n_words[window])
        return window[ok], item[ok], distance[ok]

    def scan(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, float, int]]:
        """(row, item, first word, words, similarity, distance): the best window of each pair."""
        for first, part in words.text_slices(texts, PART):
            value, of, weight, n_words = _shingled(part)
            hit = np.flatnonzero(self.maybe[value >> np.uint64(44)])
            if not len(hit) or not len(self.value):
                continue
            place = np.minimum(np.searchsorted(self.value, value[hit]), len(self.value) - 1)
            same = self.value[place] == value[hit]
            hit, place = hit[same], place[same]
            if not len(hit):
                continue
            count = np.bincount(of, minlength=len(part))
            begin = np.cumsum(count) - count
            for row in np.unique(of[hit]):
                mine = of[hit] == row if len(hit) < 64 else slice(*np.searchsorted(of[hit], [row, row + 1]))
                a = begin[row]
                yield from (
                    (first + int(row), *found)
                    for found in self._row(
                        value[a : a + count[row]], weight[a : a + count[row]], int(n_words[row]), hit[mine] - a, place[mine]
                    )
                )

    def _row(self, value, weight, n_words, hit, place) -> list[tuple[int, int, int, float, int]]:
        """The best window for each item found in one text; ``hit`` are places of item shingles."""
        wanted: dict[int, list[int]] = {}
        for at, which in zip(hit.tolist(), place.tolist()):
            for size in self.sizes[which].tolist():
                wanted.setdefault(size, []).append(at)
        best: dict[int, tuple[int, int, int, float, int]] = {}
        for size, places in wanted.items():
            width = min(max(size - N + 1, 1), len(value))
            at = np.array(places, dtype=np.int64)
            low, high = np.maximum(at - width + 1, 0), np.minimum(at, len(value) - width)
            starts = np.unique(expand(low, np.maximum(high, low) + 1))
            starts = starts[starts <= len(value) - width]
            taken = 0
            while taken < len(starts):
                base = int(starts[taken])
                upto = int(np.searchsorted(starts, base + SPAN))
                some = starts[taken:upto]
                taken = upto
                stop = int(some[-1]) + width
                sums = np.concatenate(
                    [np.zeros((1, 64), np.int64), np.cumsum(_signs(value[base:stop], weight[base:stop]), axis=0)]
                )
                finger = _packed(sums[some - base + width] - sums[some - base])
                window, item, distance = self.candidates(finger, np.full(len(some), size))
                for w, i, d in zip(window.tolist(), item.tolist(), distance.tolist()):
                    s = int(some[w])
                    distinct, f = np.unique(value[s : s + width], return_index=True)
                    mass = weight[s : s + width][f]
                    common = int(mass[np.isin(distinct, self.sets[i], assume_unique=True)].sum())
                    union = int(mass.sum()) + self.total[i] - common
                    if 100 * common >= self.percent * union:
                        found = (i, s, min(size, n_words), common / union, d)
                        if i not in best or (found[3], -s) > (best[i][3], -best[i][1]):
                            best[i] = found
        return [best[i] for i in sorted(best)]


def _indexes(benchmark: DataFrame, percent: int) -> Iterator[Index]:
    """An index for each block of items; a block is dealt by hash and at most so large."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 32), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_BYTES)
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        rows.sort(key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["text"]))
        if rows:
            yield Index([r["item_id"] for r in rows], [r["text"] for r in rows], percent)


def find(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """A row for each document and item with a window of at least ``percent`` similarity."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], FOUND)
    for index in _indexes(benchmark, percent):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32())
            names = ("doc_id", "item_id", "first_word", "n_words", "similarity", "distance")
            for batch in batches:
                ids, out = batch.column("doc_id"), []
                for row, item, start, size, similarity, distance in shared.value.scan(batch.column("text")):
                    out.append((ids[row].as_py(), shared.value.ids[item], start, size, similarity, distance))
                columns = list(zip(*out)) if out else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
                give_back()

        one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        found = found.union(one.mapInArrow(run, FOUND))
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, as they are, in whose text no item is found."""
    # plain names inside: a column may have a dot in its name
    names, at = docs.columns, docs.columns.index("text")
    kept = docs.toDF(*[f"c{k}" for k in range(len(names))])
    for index in _indexes(benchmark, percent):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for row, *_ in shared.value.scan(batch.column(at).cast(pa.large_string())):
                    keep[row] = False
                yield batch.filter(pa.array(keep))
                give_back()

        kept = kept.mapInArrow(run, kept.schema)
    return kept.toDF(*names)
