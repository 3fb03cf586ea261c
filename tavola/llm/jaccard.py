"""Jaccard join of documents on their word n-grams, by a prefix tree.

1. *Sets.* A document's set is its distinct shingles of ``n`` words (A-Z lowered), as 64-bit
   hashes in ascending order: the global order. Equal sets are one class.
2. *Meeting.* The shingles of a set are put in order of how frequent they are in the corpus,
   rare ones first. Where sets of sizes a and b link, the first a - ceil(t a) + k of the one and
   the first b - ceil(t b) + k of the other have k shingles or more in common, for any k up to
   the overlap, whatever the order; k is a twentieth of the smaller size, and 1 more. A row for
   each of these shingles goes to its key, and sets of sizes that can link and that share k keys
   are a candidate pair. What many documents have in common comes last in the order, so a key
   has few sets, but where they are near copies. A key of more than ``HOT`` sets does not count
   for each pair: it puts its sets into one dense group. The frequencies are counts by ``BITS``
   bits of the hash, kept as their logarithm (a table of fixed size); a wrong one costs time but
   never a link.
3. *Join.* The ordered sets of a task form a prefix tree. All sets of one side walk down the
   tree of the other together, level by level; sets with a common prefix are one node and
   share the overlap found so far. A subtree is left when the overlap so far and what remains
   on both sides cannot reach the threshold for the smallest set below it. A task returns a
   spanning forest of its links. Components of candidates of up to ``block`` sets are a task
   each. In larger ones the dense groups are dealt to blocks, ``DEALS`` times anew, so that near
   copies of one text become one component in linear time; then the candidate pairs that are
   not in one component are compared, and the sets of a dense group outside its largest
   component with all others of it whose sizes can link. Dense sets of such sizes that do not
   link cost the square of their number.
4. *Components* of the links, over classes, give each document its class id.

No group is gathered whole, and copies are folded before anything is paired.

Rows: a missing or empty text, or one without words, has an empty set and links with nothing;
fewer words than ``n`` are one shingle. Rows that repeat a doc_id are separate documents that
share an id; a row without doc_id takes part in links but is never a class id, unless its whole
class has none. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.llm import words
from tavola.llm.components import components
from tavola.llm.pieces import expand
from tavola.llm.resident import give_back
from tavola.llm.shared import stored
from tavola.llm.tables import text_key

BLOCK = 256
#: Bytes of text whose sets a worker makes at a time; their arrays take some thirty times as much.
PART = 500_000


def required(a: int, b: int, percent: int) -> int:
    """Least overlap of sets of sizes a and b with 100 * overlap >= percent * union."""
    return -(-(a + b) * percent // (100 + percent))


def prefix(size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of the first shingles of a set are its keys, and how many of them a linked set of
    this size or larger has too."""
    least = -(-size * percent // 100)
    common = np.minimum(1 + size // 20, least)
    return size - least + common, common


def _slices(batches: Iterator[pa.RecordBatch], n: int):
    """Of parts of a batch: the batch, first row, rows, and the sets with the row of each shingle."""
    for batch in batches:
        for first, part in words.text_slices(batch.column("text"), PART):
            yield batch, first, len(part), *_sets(part, n)
            give_back()


def _sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of texts, one after another, and the row of each shingle."""
    data, begin, end, row = words.spans(texts)
    return words.sets(words.hashes(data, begin, end, lower=True), row, n)


def _class_of(value: np.ndarray, of: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The size of each row's set, and 64 bits that stand for the set (0: empty)."""
    size = np.bincount(of, minlength=rows).astype(np.int64)
    total = np.zeros(rows, dtype=np.uint64)
    np.add.at(total, of, words.mix(value))
    name = words.mix(total + size.astype(np.uint64))
    return size, np.where(size > 0, name, 0).view(np.int64)


#: Shingles are counted by so many bits of their hash; the last ``_LOW`` of them are sent as numbers.
BITS = 24
_LOW = 16


def _bucket(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - BITS)).astype(np.int64)


def _classes(n: int):
    """A row for each document, and one for each block of buckets with those of a part's shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "part", "n_shingles", "cls", "block", "low"]
        for batch, first, rows, value, of in _slices(batches, n):
            size, name = _class_of(value, of, rows)
            of_rows = [batch.column(c).slice(first, rows) for c in ("doc_id", "part")]
            none = [pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([*of_rows, pa.array(size), pa.array(name), *none], names=names)
            bucket = np.sort(_bucket(value).astype(np.uint32))
            block, start = np.unique(bucket >> np.uint32(_LOW), return_index=True)
            parts = np.split((bucket & np.uint32((1 << _LOW) - 1)).astype(np.uint16), start[1:])
            low = [p.tobytes() for p in parts[: len(block)]]
            none = [pa.nulls(len(block), t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64())]
            counted = [pa.array(block.astype(np.int32)), pa.array(low, pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, *counted], names=names)

    return run


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block, the levels of its buckets: eight times the logarithm of 1 more than the count."""
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, low in zip(batch.column("block").to_pylist(), batch.column("low").to_pylist()):
            total = counts.setdefault(block, np.zeros(1 << _LOW, dtype=np.int64))
            total += np.bincount(np.frombuffer(low, dtype=np.uint16), minlength=1 << _LOW)
    levels = [np.rint(8 * np.log2(1 + c)).astype(np.uint8).tobytes() for c in counts.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(levels, pa.binary())], names=["block", "level"])


def _frequencies(classes: DataFrame) -> np.ndarray:
    """The level of each bucket of shingles, of which there are 2 ** BITS."""
    total = np.zeros(1 << BITS, dtype=np.uint8)
    rows = classes.where("block is not null").select("block", "low").repartition("block")
    for block, level in rows.mapInArrow(_levels, "block int, level binary").collect():
        total[block << _LOW : (block + 1) << _LOW] = np.frombuffer(level, dtype=np.uint8)
    return total


def first_shingles(
    value: np.ndarray, of: np.ndarray, size: np.ndarray, frequency: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """The keys of sets and their rows: the first shingles by the frequency of their bucket."""
    order = np.lexsort((value, frequency[_bucket(value)], of))
    nth = np.arange(len(value)) - np.repeat(np.cumsum(size) - size, size)
    keep = nth < np.repeat(prefix(size, percent)[0], size)
    return value[order][keep], of[keep]


def _keys(n: int, percent: int, shared: Broadcast[np.ndarray]):
    """A row (key, cls, size) for each key of each set, once for each set that a task meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        frequency = shared.value
        for _, _, rows, value, of in _slices(batches, n):
            size, name = _class_of(value, of, rows)
            new = np.zeros(rows, dtype=bool)
            for k in np.flatnonzero(size).tolist():
                new[k] = (cls := int(name[k])) not in seen
                seen.add(cls)
            mine = new[of]
            size = np.where(new, size, 0)
            key, row = first_shingles(value[mine], of[mine], size, frequency, percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(name[row]), pa.array(size[row].astype(np.int32))],
                names=["key", "cls", "size"],
            )

    return run


def tree_links(
    sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places (x, y) of linked sets, x of ``left`` and y of ``right``, by a walk down a tree.

    ``sets`` hold ascending hashes. The tree of the right sets is kept as their sorted order
    with the length of the prefix that each shares with the one before it.
    """
    universe, flat = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    end = np.cumsum(size)
    begin = end - size
    # membership of a left set: its (set, shingle) pairs in order
    width = len(universe)
    pairs = np.concatenate([flat[begin[x] : end[x]] + k * width for k, x in enumerate(left)])
    rank_base = np.cumsum(size[left]) - size[left]
    ordered = sorted(right, key=lambda y: flat[begin[y] : end[y]].tolist())
    tree = np.array(ordered, dtype=np.int64)
    m = len(tree)
    shared = np.zeros(m, dtype=np.int64)
    for k in range(1, m):
        a, b = (flat[begin[y] : end[y]] for y in tree[k - 1 : k + 1])
        length = min(len(a), len(b))
        differ = np.flatnonzero(a[:length] != b[:length])
        shared[k] = differ[0] if len(differ) else length
    found_x, found_y = [], []
    # frontier: a left set and a node, which is a run of the tree's order from ``at`` to ``to``
    x = np.arange(len(left), dtype=np.int64)
    at, to = np.zeros(len(left), np.int64), np.full(len(left), m, np.int64)
    overlap, depth, step = np.zeros(len(left), np.int64), 0, 2
    sizes = size[tree]
    while len(x):
        # children after ``step`` more shingles: a run breaks where less than that is shared
        deeper = depth + step
        breaks = np.flatnonzero(shared < deeper)
        first_break = np.searchsorted(breaks, at, side="right")
        last_break = np.searchsorted(breaks, to, side="left")
        breaks = np.append(breaks, m)
        parts = last_break - first_break + 1
        node = np.repeat(np.arange(len(x)), parts)
        nth = np.arange(len(node)) - np.repeat(np.cumsum(parts) - parts, parts)
        pick = first_break[node] + nth
        child_at = np.where(nth == 0, at[node], breaks[np.minimum(pick - 1, len(breaks) - 1)])
        child_to = np.where(nth == parts[node] - 1, to[node], breaks[np.minimum(pick, len(breaks) - 1)])
        x, overlap = x[node], overlap[node]
        at, to = child_at, child_to
        # what the left set shares with the path of the child
        member = tree[at]
        there = np.minimum(size[member], deeper) - np.minimum(size[member], depth)
        total = int(there.sum())
        if total:
            entry = np.repeat(np.arange(len(x)), there)
            nth = np.arange(total) - np.repeat(np.cumsum(there) - there, there)
            token = flat[begin[member[entry]] + depth + nth]
            wanted = token + x[entry] * width
            place = np.searchsorted(pairs, wanted)
            hit = pairs[np.minimum(place, len(pairs) - 1)] == wanted
            overlap = overlap + np.bincount(entry, weights=hit, minlength=len(x)).astype(np.int64)
            # how far the left set has come in the global order: the place of the last shingle
            last = np.cumsum(there) - 1
            come = np.zeros(len(x), np.int64)
            has = there > 0
            come[has] = (place + hit)[last[has]] - rank_base[x[has]]
        else:
            come = np.zeros(len(x), np.int64)
        depth = deeper
        done = size[member] <= depth
        mine = size[left[x]]
        whole = done & (to - at == 1)
        # sets that end here
        reach = overlap >= -(-(mine + size[member]) * percent // (100 + percent))
        ok = whole & reach
        found_x.append(left[x[ok]])
        found_y.append(member[ok])
        go = ~whole
        x, at, to, overlap, mine, come = x[go], at[go], to[go], overlap[go], mine[go], come[go]
        if not len(x):
            break
        # the smallest and largest set below a node bound what can still be reached
        smallest = _run_reduce(np.minimum, sizes, at, to)
        largest = _run_reduce(np.maximum, sizes, at, to)
        best = overlap + np.minimum(np.maximum(largest - depth, 0), mine - come)
        need = -(-(mine + np.maximum(smallest, 0)) * percent // (100 + percent))
        alive = best >= need
        x, at, to, overlap = x[alive], at[alive], to[alive], overlap[alive]
        step = min(step * 2, 64)
    if not found_x:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_x), np.concatenate(found_y)


def _run_reduce(ufunc, values: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """``ufunc`` over values[at:to] for each run; runs are not empty."""
    bounds = np.stack([at, to], axis=1).ravel()
    padded = np.append(values, values[-1])
    return ufunc.reduceat(padded, bounds)[::2]


def _forest(n: int, x: np.ndarray, y: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of the links."""
    parent = list(range(n))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    keep_x, keep_y = [], []
    for a, b in zip(x.tolist(), y.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            keep_x.append(a)
            keep_y.append(b)
    return keep_x, keep_y


def _join_task(n: int, percent: int):
    """Links of the sets of one task: those of side 0 with those of side 1, those of side 2 with
    each other; a spanning forest of them."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        give_back()
        # in order of the class, so that the walk does not depend on the order of rows
        frame = frame.drop_duplicates("cls").sort_values("cls", kind="stable")
        sets: list[np.ndarray] = []
        for _, part in words.text_slices(pa.array(frame.pop("text"), pa.large_string()), PART):
            value, of = _sets(part, n)
            size = np.bincount(of, minlength=len(part))
            sets += np.split(value, np.cumsum(size)[:-1])
        side = frame["side"].to_numpy()
        names = frame["cls"].to_numpy()
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        x, y = tree_links(sets, left, right, percent)
        keep = x != y
        x, y = _forest(len(frame), x[keep], y[keep])
        return pd.DataFrame({"a": names[x], "b": names[y]}, dtype="int64")

    return run


#: Keys of more classes than this join them all; those of fewer count for each pair.
HOT = 64


def _edges(percent: int):
    """From rows in order of (key, cls): pairs (a, b) of sizes that can link, with the keys that
    they share and the keys that they need. A key of many classes puts all of them with the least
    one, at no need (free)."""

    def pairs(key, cls, size, hot):
        """The rows of whole keys; ``hot`` (key, least class) if the first key went before."""
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
        key, cls, size = key[new], cls[new], size[new]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(start, len(key)))
        end = np.repeat(start + count, count)
        many = np.repeat(count > HOT, count)
        least = np.repeat(cls[start], count)
        if hot is not None and key[0] == hot[0]:
            many[: count[0]], least[: count[0]] = True, hot[1]
        star = many & (cls != least)
        here = np.flatnonzero(~many)
        left = np.repeat(here, end[here] - here - 1)
        right = expand(here + 1, end[here])
        small, large = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
        near = 100 * small >= percent * large
        left, right, small = left[near], right[near], small[near]
        a = np.concatenate([least[star], cls[left]])
        b = np.concatenate([cls[star], cls[right]])
        need = np.concatenate([np.zeros(int(star.sum()), np.int64), prefix(small, percent)[1]])
        order = np.lexsort((b, a, need == 0))
        a, b, need = a[order], b[order], need[order]
        first = np.ones(len(a), dtype=bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (need[1:] != need[:-1])
        first = np.flatnonzero(first)
        shared = np.diff(np.append(first, len(a)))
        columns = [a[first], b[first], shared, need[first], need[first] == 0]
        rows = pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["a", "b", "shared", "need", "free"]
        )
        return rows, (key[-1], least[-1]) if many[-1] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        hot = None
        for batch in batches:
            columns = [batch.column(c).to_numpy().astype(np.int64) for c in ("key", "cls", "size")]
            rows = [np.concatenate([h, c]) for h, c in zip(held, columns)]
            if not len(rows[0]):
                continue
            # the last key may go on: its classes wait, unless they are many already
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            _, once = np.unique(rows[1][last:], return_index=True)
            held = [r[last:][once] for r in rows]
            if len(once) > HOT:
                last = len(rows[0])
                held = [h[:0] for h in held]
            if last:
                made, hot = pairs(*(r[:last] for r in rows), hot)
                yield made
            give_back()
        if len(held[0]):
            yield pairs(*held, hot)[0]

    return run


def _candidates(rows: DataFrame, n: int, percent: int, frequency: np.ndarray) -> DataFrame:
    """Pairs of classes (a, b) that share enough keys, and those that stand for a key of many
    classes (free): all classes of such a key are candidates of each other."""
    # as part of the function, workers would hold the table twice
    shared = rows.sparkSession.sparkContext.broadcast(frequency)
    keyed = rows.select("text").mapInArrow(_keys(n, percent, shared), "key long, cls long, size int")
    met = keyed.repartition("key").sortWithinPartitions("key", "cls")
    pairs = met.mapInArrow(_edges(percent), "a long, b long, shared long, need long, free boolean")
    enough = (
        pairs.groupBy("a", "b", "free")
        .agg(F.sum("shared").alias("shared"), F.max("need").alias("need"))
        .where(F.col("free") | (F.col("shared") >= F.col("need")))
    )
    candidates = stored(enough.select("a", "b", "free"), "candidates")
    shared.destroy()
    return candidates


#: How often the sets of a dense group are dealt to blocks anew before what is left is compared.
DEALS = 3


def _task(kind: str, *parts: str | Column) -> Column:
    return F.concat_ws("-", F.lit(kind), *parts).alias("task")


def _dense(pairs: DataFrame, block: int) -> DataFrame:
    """cls, root and blocks of the classes that keys of many classes put together."""
    dense = stored(components(pairs.where("free").select("a", "b")), "dense")
    sizes = dense.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    return stored(dense.join(sizes, "root").select(F.col("node").alias("cls"), "root", "blocks"), "blocks")


def _dealt(dense: DataFrame) -> DataFrame:
    """(task, side, cls): dense groups in blocks, those of several blocks ``DEALS`` times."""
    tasks = None
    for deal in range(DEALS):
        nth = F.pmod(F.xxhash64("cls", F.lit(deal)), "blocks")
        of_deal = (dense.where("blocks > 1") if deal else dense).select(
            _task(f"h{deal}", "root", nth), F.lit(2).alias("side"), "cls"
        )
        tasks = of_deal if tasks is None else tasks.union(of_deal)
    return tasks


def _pair_tasks(pairs: DataFrame, linked: DataFrame, block: int) -> DataFrame:
    """(task, side, cls): the candidates of each class that are not in one component with it."""
    of = linked.select("node", F.col("root").alias("of"))
    apart = (
        pairs.where("not free")
        .join(of.toDF("a", "of_a"), "a", "left")
        .join(of.toDF("b", "of_b"), "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
        .select("a", "b")
    )
    apart = stored(apart, "apart")
    parts = apart.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    stars = apart.join(parts, "a").withColumn("nth", F.pmod(F.xxhash64("b"), "parts"))
    of_star = _task("s", "a", "nth")
    return stars.select(of_star, F.lit(1).alias("side"), F.col("b").alias("cls")).union(
        stars.select(of_star, F.lit(0), F.col("a")).distinct()
    )


def _band(percent: int) -> Column:
    """Sets whose bands differ by more than 1 are of sizes that cannot link."""
    # a little wider than needed, so that rounding never parts sets that can
    return F.floor(F.log("n_shingles") / (math.log(100 / percent) + 1e-9)).cast("long").alias("band")


def _last_tasks(dense: DataFrame, linked: DataFrame, sizes_of: DataFrame, percent: int, block: int) -> DataFrame:
    """(task, side, cls): of the sets of a dense group of several blocks, those outside its largest
    component so far with all others of their band and the next. Where all are one component there
    is nothing left to compare."""
    component = F.coalesce("of", "cls").alias("component")
    found = dense.where("blocks > 1").join(
        linked.select(F.col("node").alias("cls"), F.col("root").alias("of")), "cls", "left"
    )
    found = stored(found.join(sizes_of, "cls").select("root", "cls", component, _band(percent)), "found")
    sizes = found.groupBy("root", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("root").agg(
        F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("total")
    )
    largest = stored(
        largest.where("total > top.n").select("root", F.col("top.component").alias("largest")), "largest"
    )
    # each set is in the range of its own band and in that of the band below, as its upper half
    inside = (F.col("component") == F.col("largest")).alias("inside")
    rows = found.join(largest, "root").select("root", "cls", "band", inside)
    halves = rows.withColumn("upper", F.explode(F.array(F.lit(0), F.lit(1))))
    halves = halves.withColumn("range", F.col("band") - F.col("upper")).drop("band")
    keys = ["root", "range"]
    counts = stored(
        halves.groupBy(*keys).agg(
            F.count_if("inside").alias("top"), F.count_if(~F.col("inside")).alias("beyond")
        ).where("beyond > 0").select(
            *keys,
            F.greatest(F.lit(1), F.ceil(F.col("top") / block)).cast("int").alias("inner"),
            F.ceil(F.col("beyond") / block).cast("int").alias("outer"),
        ),
        "counts",
    )
    rows = halves.join(counts, keys)
    own = F.xxhash64("cls", F.lit(DEALS))

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    within = rows.where("inside").withColumns({"k": F.pmod(own, "inner"), "o": each("outer")})
    beyond = rows.where("not inside").withColumn("o", F.pmod(own, "outer"))
    across = within.select(_task("l", *keys, "o", "k"), F.lit(1).alias("side"), "cls").union(
        beyond.withColumn("k", each("inner")).select(_task("l", *keys, "o", "k"), F.lit(0), "cls")
    )
    met = beyond.withColumn("p", each("outer"))
    side = F.when(F.col("o") == F.col("p"), 2).when(F.col("o") < F.col("p"), 0).otherwise(1)
    return across.union(met.select(_task("o", *keys, F.least("o", "p"), F.greatest("o", "p")), side, "cls"))


def _members(docs: DataFrame, n: int, percent: int, block: int) -> DataFrame:
    """doc_id, part (key of the text), n_shingles and cluster (null for an empty set) of every row.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = rows.withColumn("part", text_key())
    classes = stored(
        keyed.mapInArrow(
            _classes(n), "doc_id long, part string, n_shingles long, cls long, block int, low binary"
        ),
        "classes",
    )
    sized = classes.where("block is null").drop("block", "low")
    candidates = _candidates(rows, n, percent, _frequencies(classes))
    groups = stored(components(candidates.select("a", "b")), "groups")
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    placed = stored(groups.join(sizes, "root").select(F.col("node").alias("cls"), "root", "size"), "placed")
    # one document of each class speaks for it
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "part")).alias("of")
    speakers = (
        sized.where("cls <> 0")
        .groupBy("cls")
        .agg(first)
        .join(placed, "cls")
        .select("cls", F.col("of.doc_id").alias("id"), F.col("of.part").alias("of"))
    )
    spoken = keyed.join(speakers, keyed["doc_id"].eqNullSafe(F.col("id")) & (F.col("part") == F.col("of")))
    texts = stored(spoken.select("text", "cls").dropDuplicates(["cls"]), "texts")

    def links_of(tasks: DataFrame) -> DataFrame:
        return tasks.join(texts, "cls").groupBy("task").applyInPandas(_join_task(n, percent), "a long, b long")

    whole = placed.where(F.col("size") <= block).select(_task("g", "root"), F.lit(2).alias("side"), "cls")
    larger = placed.where(F.col("size") > block).select("cls")
    if larger.isEmpty():
        found = components(links_of(whole))
    else:
        pairs = stored(candidates.join(larger.withColumnRenamed("cls", "a"), "a", "left_semi"), "pairs")
        dense = _dense(pairs, block)
        links = stored(links_of(whole.union(_dealt(dense))), "links")
        found = stored(components(links), "found")
        sizes_of = sized.where("cls <> 0").groupBy("cls").agg(F.max("n_shingles").alias("n_shingles"))
        rest = _pair_tasks(pairs, found, block).union(_last_tasks(dense, found, sizes_of, percent, block))
        found = components(links.union(links_of(rest)))
    member = sized.join(found, sized["cls"] == found["node"], "left").select(
        "doc_id", "part", "n_shingles", F.when(F.col("cls") != 0, F.coalesce("root", "cls")).alias("cluster")
    )
    return stored(member, "members")


def join(docs: DataFrame, n: int = 3, percent: int = 90, block: int = BLOCK) -> DataFrame:
    """doc_id, part (key of the text), n_shingles and component_id of every row."""
    member = _members(docs, n, percent, block)
    ids = member.where("cluster is not null").groupBy("cluster").agg(F.min("doc_id").alias("least"))
    # written apart, so that a hot component can be split in the join
    ids = stored(ids, "least")
    return member.join(ids, "cluster", "left").select(
        "doc_id", "part", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for three-word shingles and a similarity of 0.9."""
    return join(docs, 3, 90).drop("part")


def keep_first(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` of each group of linked documents, and all that link with nothing.

    The row with the smallest id stays, missing ids last, then that with the smallest text key.
    Of rows with equal ids and texts one stays; where their other columns differ, a hash decides.
    Rows without words have no group and all stay.
    """
    linked = _members(docs.select("doc_id", "text"), n, percent, BLOCK).where("cluster is not null")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "part")
    # written apart, so that a hot component can be split in the join
    first = stored(linked.groupBy("cluster").agg(F.min(order).alias("first")), "first")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("part") == F.col("first.part"))
    told = (
        linked.join(first, "cluster")
        .groupBy(F.col("doc_id").alias("_id"), F.col("part").alias("_part"))
        .agg(F.max(stays).alias("_stays"), F.count(F.lit(1)).alias("_n"))
    )
    out = stored(told.where("not _stays or _n > 1"), "out")

    def met(side: DataFrame, how: str) -> DataFrame:
        return docs.join(side, docs["doc_id"].eqNullSafe(side["_id"]) & (text_key() == side["_part"]), how)

    kept = met(out, "left_anti")
    repeated = out.where("_stays")
    if repeated.isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    single = (
        met(repeated, "left_semi")
        .groupBy(F.col("doc_id").alias("_id"), text_key().alias("_part"))
        .agg(F.min_by(row, F.xxhash64(row.cast("string"))).alias("_row"))
    )
    return kept.union(single.select("_row.*"))


#: DuckDB SQL for the rows of ``digest``, for a table of distinct ids.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\v\f\r]+') AS w
  FROM documents
), g AS (
  SELECT DISTINCT doc_id,
         unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
                END) AS gram
  FROM w WHERE len(w) > 0
), s AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN s sx ON sx.doc_id = x JOIN s sy ON sy.doc_id = y
  WHERE 100 * shared >= 90 * (sx.n + sy.n - shared)
), r(doc_id, reach) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.reach
)
SELECT doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(reach) AS component_id
FROM r LEFT JOIN s USING (doc_id) GROUP BY doc_id
"""
