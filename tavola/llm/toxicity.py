"""Toxicity by a convolutional text classifier, trained on Spark with numpy in the tasks.

A text is its words (runs of letters and digits, A-Z lowered) as 64-bit hashes. Hashes that
occur in three or more training documents, and in one of ``RARE`` of the toxic or of the other
ones, have an embedding, found through a table of their leading bits; all others share the zero
vector. So the vocabulary is bounded by the length of a document, not by the number of them. Filters of one, two and three words slide over
the whole text, the highest response of each filter is kept, and a logistic layer weighs these.
Everything is linear before the maximum, so that scoring adds up rows of ready-made tables.

The language of a text is guessed from its words (naive Bayes over the same hashes), and the
score is shifted by the language's threshold, which is set on training rows kept aside, so that
0.5 is the border in every language. Language, source, labels and ids are no input of a score.

``fit`` learns from every labelled document that the given condition lets in: the words that
are known, the counts of the languages, the weights and the thresholds. One row of a repeated
doc_id is learnt from, chosen by a hash of its text. Of five training documents one is kept
aside for the thresholds. The weights start from a network that the driver trains on at most
``rows`` documents, so that the tasks begin in one place; then, ``RATES`` times over, each task
goes through all its documents in small steps and the networks are averaged, a word's embedding
by the steps that met it. The driver gets the texts of the start only, at 8 bytes a word: 960 MB
for 6000 texts of 20,000 words each; longer texts are not cut, and take more. The thresholds
come from counts of log odds in cells of 1/``CELL``.

Rows: a missing or empty text scores like one of unknown words only. Labels without a document
and missing labels are passed over; of repeated rows each is scored. Without labelled rows of
both kinds all scores are 0; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.llm import words
from tavola.llm.shared import stored

WIDTHS = (1, 2, 3)
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
#: A known word is in one of so many toxic documents, or of the others.
RARE = 2000
#: The step sizes of the passes over all training documents.
RATES = (0.02, 0.02, 0.02, 0.02, 0.01, 0.005)
#: Documents that a task learns from before networks are averaged, at least.
TASK = 6000
#: Cells of log odds to one unit, for thresholds.
CELL = 1024
#: Embeddings that are averaged together, and words of a step at most (one text at least).
_CHUNK, _STEP_WORDS = 16384, 400_000


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _aside() -> Column:
    """Whether a training document sets thresholds: of five successive ids it is one, by the sum of
    the id's digits to the base of 5, so that evenly spaced ids are divided too."""
    digits = sum((F.expr(f"pmod(doc_id div {5**k}L, 5L)") for k in range(28)), F.lit(0))
    return F.pmod(digits, F.lit(5)) == 4


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word."""
    data, begin, end, row = words.spans(texts, letters=True)
    return words.hashes(data, begin, end, lower=True), row


class Vocabulary:
    """Places of known hashes, from 1; 0 is any other word."""

    def __init__(self, known: np.ndarray) -> None:
        self.known = np.sort(known)
        # the first known hash of each value of the leading bits, and the most that share one
        bits = min(len(self.known).bit_length() + 2, 22)
        self.rest = np.uint64(64 - bits)
        lead = (self.known >> self.rest).astype(np.int64)
        self.first = np.searchsorted(lead, np.arange((1 << bits) + 1)).astype(np.int32)
        self.most = int(np.diff(self.first).max(initial=0))

    def __reduce__(self):
        # sent to tasks without the table
        return Vocabulary, (self.known,)

    def places(self, hashed: np.ndarray) -> np.ndarray:
        lead = (hashed >> self.rest).astype(np.int64)
        at, stop = self.first[lead], self.first[lead + 1]
        out = np.zeros(len(hashed), dtype=np.int32)
        for k in range(self.most):
            here = np.flatnonzero(at + k < stop)
            same = self.known[at[here] + k] == hashed[here]
            out[here[same]] = at[here[same]] + k + 1
        return out


@dataclass
class Network:
    """Weights: embeddings, filters by width [word of the width, dimension, filter], output."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.bias, self.out, self.out_bias]


def _starts(row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    count = np.bincount(row, minlength=rows)
    return np.cumsum(count) - count, count


def _padded(place: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts with unknown ones between, so that every filter fits into every text."""
    pad = max(WIDTHS)
    start, count = _starts(row, rows)
    flat = np.zeros(len(place) + pad * rows, dtype=np.int32)
    flat[np.arange(len(place)) + pad * row] = place
    return flat, start + pad * np.arange(rows), count + pad


def _apart(response: np.ndarray, begin: np.ndarray, width: int) -> None:
    """Leave out the windows that reach into the next text."""
    for back in range(1, width):
        response[begin[1:] - back] = -np.inf


def _train(
    place: np.ndarray, row: np.ndarray, label: np.ndarray, size: int, seed: int,
    dims: int = 8, filters: int = 8, epochs: int = 6, batch: int = 64, rate: float = 0.02,
) -> Network:
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.1, (size + 1, dims)),
        [rng.normal(0, 0.3, (w, dims, filters)) for w in WIDTHS],
        [np.zeros(filters) for _ in WIDTHS],
        rng.normal(0, 0.3, filters * len(WIDTHS)),
        np.zeros(1),
    )
    net.embedding[0] = 0
    mean, square = ([np.zeros_like(p) for p in net.parts()] for _ in range(2))
    start, count = _starts(row, len(label))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), batch):
            docs = order[at : at + batch]
            some = np.concatenate([place[start[d] : start[d] + count[d]] for d in docs])
            of = np.repeat(np.arange(len(docs)), count[docs])
            slopes = _slopes(net, some, of, label[docs])
            step += 1
            for part, slope, m, s in zip(net.parts(), slopes, mean, square):
                part -= rate * _adam(slope, m, s, step)
            net.embedding[0] = 0
    return net


def _adam(slope: np.ndarray, mean: np.ndarray, square: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    """The direction of a step; ``mean`` and ``square`` are brought up to date."""
    mean += 0.1 * (slope - mean)
    square += 0.001 * (slope**2 - square)
    return mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)


class _Pass:
    """Steps of a network in place; only the embeddings of a step's words are touched."""

    def __init__(self, net: Network, rate: float) -> None:
        self.net, self.rate, self.steps = net, rate, 0
        self.met = np.zeros(len(net.embedding), dtype=np.int64)
        self.mean, self.square = ([np.zeros_like(p) for p in net.parts()] for _ in range(2))

    def step(self, place: np.ndarray, of: np.ndarray, label: np.ndarray) -> None:
        net = self.net
        used, at = np.unique(np.append(0, place), return_inverse=True)
        some = Network(net.embedding[used], net.filters, net.bias, net.out, net.out_bias)
        slopes = _slopes(some, at[1:], of, label)
        self.steps += 1
        self.met[used] += 1
        mean, square = self.mean[0][used], self.square[0][used]
        net.embedding[used] -= self.rate * _adam(slopes[0], mean, square, self.met[used, None])
        net.embedding[0] = 0
        self.mean[0][used], self.square[0][used] = mean, square
        for part, slope, m, s in zip(net.parts()[1:], slopes[1:], self.mean[1:], self.square[1:]):
            part -= self.rate * _adam(slope, m, s, self.steps)


def _slopes(net: Network, place: np.ndarray, of: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """The slope of the mean loss of some texts by each part of the network."""
    flat, begin, _ = _padded(place, of, len(label))
    vectors = net.embedding[flat]
    pooled, chosen = [], []
    for w, kernel, bias in zip(WIDTHS, net.filters, net.bias):
        n = len(flat) - w + 1
        response = sum(vectors[j : j + n] @ kernel[j] for j in range(w)) + bias
        _apart(response, begin, w)
        best = np.maximum.reduceat(response, begin, axis=0)
        # the first place of the highest response of each text and filter
        text = np.searchsorted(begin, np.arange(n), side="right") - 1
        at, f = np.nonzero(response == best[text])
        first = np.full(best.shape, -1)
        first[text[at[::-1]], f[::-1]] = at[::-1]
        pooled.append(np.maximum(best, 0))
        chosen.append(first)
    joined = np.concatenate(pooled, axis=1)
    likely = 1 / (1 + np.exp(-np.clip(joined @ net.out + net.out_bias, -30, 30)))
    error = (likely - label) / len(label)
    back = (error[:, None] * net.out) * (joined > 0)
    to_embedding = 1e-5 * net.embedding
    to_filters, to_bias = [], []
    width = net.filters[0].shape[2]
    for k, (w, kernel) in enumerate(zip(WIDTHS, net.filters)):
        part = back[:, k * width : (k + 1) * width]
        to_kernel = np.zeros_like(kernel)
        for j in range(w):
            at = chosen[k] + j
            to_kernel[j] = np.einsum("tf,tfd->df", part, vectors[at])
            np.add.at(to_embedding, flat[at], part[:, :, None] * kernel[j].T[None])
        to_filters.append(to_kernel)
        to_bias.append(part.sum(axis=0))
    return [to_embedding, *to_filters, *to_bias, joined.T @ error, np.array([error.sum()])]


class Model:
    """A trained classifier as tables over the vocabulary."""

    def __init__(self, vocabulary: Vocabulary, net: Network, languages: np.ndarray, shift: np.ndarray) -> None:
        self.vocabulary, self.net, self.languages, self.shift = vocabulary, net, languages.astype(np.float32), shift
        self.bias, self.out, self.out_bias = net.bias, net.out, float(net.out_bias[0])

    @cached_property
    def tables(self) -> list[list[np.ndarray]]:
        # made where texts are scored, as they are six times the size of the embeddings
        return [
            [(self.net.embedding @ kernel[j]).astype(np.float32) for j in range(w)] for w, kernel in zip(WIDTHS, self.net.filters)
        ]

    def odds(self, place: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Log odds of each text before its language's shift."""
        flat, begin, _ = _padded(place, row, rows)
        pooled = []
        for w, tables, bias in zip(WIDTHS, self.tables, self.bias):
            n = len(flat) - w + 1
            response = tables[0][flat[:n]]
            for j in range(1, w):
                response += tables[j][flat[j : j + n]]
            _apart(response, begin, w)
            pooled.append(np.maximum(np.maximum.reduceat(response, begin, axis=0) + bias, 0))
        return np.concatenate(pooled, axis=1) @ self.out + self.out_bias

    def language(self, place: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """The likeliest language of each text."""
        start, count = _starts(row, rows)
        total = np.zeros((rows, self.languages.shape[1]))
        has = np.flatnonzero(count)
        if len(has):
            total[has] = np.add.reduceat(self.languages[place], start[has], axis=0)
        return total.argmax(axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = []
        for _, part in words.text_slices(texts, 2_000_000):
            hashed, row = _hashed(part)
            place = self.vocabulary.places(hashed)
            odds = self.odds(place, row, len(part)) - self.shift[self.language(place, row, len(part))]
            out.append(1 / (1 + np.exp(-np.clip(odds, -500, 500))))
        return np.concatenate(out) if out else np.zeros(0)


def _threshold(cell: np.ndarray, hits: np.ndarray, count: np.ndarray) -> float:
    """The border between two cells of log odds with the best F1; in the middle of the gap."""
    order = np.argsort(-cell)
    odds, hits, count = (cell[order] + 0.5) / CELL, np.cumsum(hits[order]), np.cumsum(count[order])
    k = int((2 * hits / (count + hits[-1])).argmax())
    return float((odds[k] + odds[k + 1]) / 2) if k + 1 < len(odds) else float(odds[k] - 1)


def _training(docs: DataFrame, labels: DataFrame, allowed: Column) -> DataFrame:
    """doc_id, toxic, aside, lang and hashes of the words of each training document, in an order
    of its own."""
    truth = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = docs.select("doc_id", F.xxhash64("text").alias("key"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text")
    rows = (
        some.where("doc_id is not null")
        .where(allowed)
        .mapInArrow(_packed, "doc_id long, key long, lang string, packed binary")
        .join(truth.where(allowed).where("toxic in (0, 1)"), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min(F.struct("key", "lang", "packed")).alias("of"))
        .select("doc_id", "of.packed", "of.lang", "toxic", _aside().alias("aside"))
        .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    )
    return stored(rows.mapInArrow(_to_hashes, "doc_id long, toxic int, aside boolean, lang string, hashes binary"), "training")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, as they are sorted and sent to other tasks."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        packed = pa.array([zlib.compress(t or b"", 1) for t in texts], pa.binary())
        of = [batch.column("doc_id").cast(pa.int64()), *(batch.column(c) for c in ("key", "lang")), packed]
        yield pa.RecordBatch.from_arrays(of, names=["doc_id", "key", "lang", "packed"])


def _to_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at, packed in words.text_slices(whole.column("packed"), 2_000_000):
            some = whole.slice(at, len(packed))
            part = pa.array([zlib.decompress(t) for t in packed.to_pylist()], pa.large_binary())
            hashed, row = _hashed(part)
            start, count = _starts(row, len(part))
            packed = [hashed[a : a + n].tobytes() for a, n in zip(start, count)]
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id").cast(pa.int64()), some.column("toxic").cast(pa.int32()), *(some.column(c) for c in ("aside", "lang")), pa.array(packed, pa.binary())],
                names=["doc_id", "toxic", "aside", "lang", "hashes"],
            )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of batches of about a million words, with their hashes and the row of each."""
    for batch in batches:
        for first, part in words.text_slices(batch.column("hashes"), 8_000_000):
            count = [len(h) // 8 for h in part.to_pylist()]
            hashed = np.frombuffer(b"".join(part.to_pylist()), dtype=np.uint64)
            yield batch.slice(first, len(part)), hashed, np.repeat(np.arange(len(part)), count)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each hash and language: how often it occurs, in how many toxic documents and in others."""
    for batch, hashed, row in _unpacked(batches):
        met = pa.table({"row": row, "hash": hashed.view(np.int64)})
        met = met.group_by(["row", "hash"], use_threads=False).aggregate([([], "count_all")])
        of = met.column("row").combine_chunks()
        toxic = batch.column("toxic").take(of).cast(pa.int64())
        other = pa.array(1 - toxic.to_numpy())
        columns = [met.column("hash"), batch.column("lang").take(of), met.column("count_all"), toxic, other]
        names = ["hash", "lang", "n", "toxic", "other"]
        sums = pa.table(columns, names=names).group_by(names[:2], use_threads=False).aggregate([(c, "sum") for c in names[2:]])
        yield from sums.select(["hash", "lang", "n_sum", "toxic_sum", "other_sum"]).rename_columns(names).to_batches()


def _known(training: DataFrame, toxic: int, other: int) -> tuple[np.ndarray, pa.Table]:
    """The known hashes, and how often each occurs in each language."""
    rows = training.select("toxic", "lang", "hashes").mapInArrow(_counted, "hash long, lang string, n long, toxic long, other long")
    # languages are added up first, then hashes, in one exchange
    sums = [F.sum(c).alias(c) for c in ("n", "toxic", "other")]
    counts = rows.repartition("hash").groupBy("hash", "lang").agg(*sums)
    often = (F.col("toxic") * RARE >= toxic) | (F.col("other") * RARE >= other)
    known = (
        counts.groupBy("hash")
        .agg(*sums[1:], F.collect_list(F.struct("lang", "n")).alias("of"))
        .where((F.col("toxic") + F.col("other") >= 3) & often)
    )
    table = known.select("hash", F.inline("of")).toArrow()
    return np.unique(table.column("hash").to_numpy()).astype(np.int64).view(np.uint64), table


def _first_network(training: DataFrame, vocabulary: Vocabulary, rows: int, seed: int) -> Network:
    """A network trained on the driver with up to ``rows`` documents, half as many toxic ones as
    others; words that are not in them start at 0."""
    taken = None
    for toxic, most in ((1, rows // 3), (0, rows - rows // 3)):
        some = training.where(F.col("toxic") == toxic).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        taken = some if taken is None else taken.union(some)
    sample = training.join(F.broadcast(taken), "doc_id").where("not aside").select("doc_id", "toxic", "hashes").collect()
    sample.sort(key=lambda r: r["doc_id"])
    label = np.array([r["toxic"] for r in sample], dtype=float)
    row = np.repeat(np.arange(len(sample)), [len(r["hashes"]) // 8 for r in sample])
    place = [vocabulary.places(np.frombuffer(r["hashes"], dtype=np.uint64)) for r in sample]
    del sample  # the driver holds the words once
    used, at = np.unique(np.concatenate([np.zeros(1, np.int32), *place]), return_inverse=True)
    net = _train(at[1:], row, label, len(used) - 1, seed)
    embedding = np.zeros((len(vocabulary.known) + 1, net.embedding.shape[1]))
    embedding[used] = net.embedding
    return Network(embedding, net.filters, net.bias, net.out, net.out_bias)


def _passed(shared, rate: float, batch: int = 64):
    """One pass over a task's documents; rows of (chunk, task, sums by weight and the weights)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start = shared.value
        net = Network(start.embedding.astype(float), *([p.copy() for p in parts] for parts in (start.filters, start.bias)), start.out.copy(), start.out_bias.copy())
        done = _Pass(net, rate)
        for some, hashed, row in _unpacked(batches):
            place, label = vocabulary.places(hashed), some.column("toxic").to_numpy().astype(float)
            begin, count = _starts(row, len(label))
            at = 0
            while at < len(label):
                fit_in = int(np.searchsorted(begin + count, begin[at] + _STEP_WORDS, side="right"))
                to = max(at + 1, min(at + batch, fit_in, len(label)))
                a, b = begin[at], begin[to - 1] + count[to - 1]
                done.step(place[a:b], row[a:b] - at, label[at:to])
                at = to
        if not done.steps:
            return
        task = TaskContext.get().partitionId()
        sums = np.column_stack([net.embedding * done.met[:, None], done.met]).astype(np.float32)
        rest = np.concatenate([p.ravel() for p in net.parts()[1:]] + [np.ones(1)]) * done.steps
        chunks = [(-1, rest.astype(np.float32))] + [(k, sums[k : k + _CHUNK]) for k in range(0, len(sums), _CHUNK)]
        for chunk, values in chunks:
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([task], pa.int32()), pa.array([values.tobytes()], pa.binary())],
                names=["chunk", "task", "sums"],
            )

    return run


def _total(frame: pd.DataFrame) -> pd.DataFrame:
    # in order of the task, so that the sum does not depend on the order of rows
    arrays = [np.frombuffer(b, dtype=np.float32).astype(float) for b in frame.sort_values("task")["sums"]]
    return pd.DataFrame({"chunk": frame["chunk"].iloc[:1].to_numpy(), "sums": [np.sum(arrays, axis=0).tobytes()]})


def _averaged(training: DataFrame, tasks: int, vocabulary: Vocabulary, net: Network, rate: float) -> Network:
    """The mean of the networks that the tasks make of ``net`` in one pass over their documents."""
    context = training.sparkSession.sparkContext
    shared = context.broadcast((vocabulary, Network(net.embedding.astype(np.float32), net.filters, net.bias, net.out, net.out_bias)))
    rows = training.where("not aside").select("toxic", "hashes").coalesce(tasks)
    sums = rows.mapInArrow(_passed(shared, rate), "chunk long, task int, sums binary")
    totals = sums.groupBy("chunk").applyInPandas(_total, "chunk long, sums binary").collect()  # one network
    shared.destroy()
    out = Network(net.embedding.copy(), *([p.copy() for p in parts] for parts in (net.filters, net.bias)), net.out.copy(), net.out_bias.copy())
    dims = net.embedding.shape[1]
    for r in totals:
        values = np.frombuffer(r["sums"], dtype=float)
        if r["chunk"] < 0:
            at = 0
            for part in out.parts()[1:]:
                part[...] = (values[at : at + part.size] / values[-1]).reshape(part.shape)
                at += part.size
        else:
            values = values.reshape(-1, dims + 1)
            met = np.flatnonzero(values[:, dims])
            out.embedding[r["chunk"] + met] = values[met, :dims] / values[met, dims:]
    return out


def _shifts(training: DataFrame, model: Model) -> np.ndarray:
    """The threshold of each language from all rows aside; a language with too few of them takes
    that of all."""
    shared = training.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, hashed, row in _unpacked(batches):
            known, rows = shared.value, some.num_rows
            place = known.vocabulary.places(hashed)
            cell = np.floor(np.clip(known.odds(place, row, rows), -64, 64) * CELL).astype(np.int32)
            guess = known.language(place, row, rows).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(guess), pa.array(cell), some.column("toxic")], names=["guess", "cell", "toxic"])

    cells = training.where("aside").select("toxic", "hashes").mapInArrow(run, "guess int, cell int, toxic int")
    counted = cells.groupBy("guess", "cell").agg(F.sum("toxic").alias("hits"), F.count(F.lit(1)).alias("n")).toArrow()
    guess, cell, hits, n = (counted.column(c).to_numpy().astype(np.int64) for c in ("guess", "cell", "hits", "n"))
    shared.destroy()
    both, of = np.unique(cell, return_inverse=True)
    overall = 0.0
    if 0 < hits.sum() < n.sum():
        overall = _threshold(both, *(np.bincount(of, weights=w, minlength=len(both)) for w in (hits, n)))
    shift = np.full(len(model.shift), overall)
    for k in range(len(shift)):
        mine = guess == k
        if hits[mine].sum() >= 20 and (n - hits)[mine].sum() >= 20:
            shift[k] = _threshold(cell[mine], hits[mine], n[mine])
    return shift


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, rows: int = 6000, seed: int = 5) -> Model | None:
    """Train on all labelled documents, from a start of ``rows``; a fifth of all sets the thresholds."""
    training = _training(docs, labels, allowed)
    totals = training.groupBy("toxic", "lang").agg(F.count(F.lit(1)).alias("n")).collect()
    toxic, other = (sum(r["n"] for r in totals if r["toxic"] == k) for k in (1, 0))
    if not toxic or not other:
        return None
    known, table = _known(training, toxic, other)
    vocabulary = Vocabulary(known)
    names = sorted({r["lang"] for r in totals})
    counts = np.ones((len(known) + 1, len(names)))
    lang = table.column("lang").combine_chunks().dictionary_encode()
    code = np.array([names.index(name) for name in lang.dictionary.to_pylist()], dtype=np.int64)
    at = vocabulary.places(table.column("hash").to_numpy().astype(np.int64).view(np.uint64))
    counts[at, code[lang.indices.to_numpy()]] += table.column("n").to_numpy()
    languages = np.log(counts / counts.sum(axis=0))
    net = _first_network(training, vocabulary, rows, seed)
    # a pass of a task is worth its cost from a hundred steps or so
    tasks = max(1, min(training.sparkSession.sparkContext.defaultParallelism, (toxic + other) // TASK))
    for rate in RATES:
        net = _averaged(training, tasks, vocabulary, net, rate)
    net.embedding = net.embedding.astype(np.float32)
    model = Model(vocabulary, net, languages, np.zeros(len(names)))
    model.shift = _shifts(training, model)
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of one half) of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                known = shared.value
                scores = known.scores(batch.column("text")) if known else np.zeros(batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, SCHEMA)


def fit_and_score(docs: DataFrame, labels: DataFrame, rows: int = 6000) -> DataFrame:
    """Train on labelled rows that are not held out, and score all rows."""
    return score(docs, fit(docs, labels, ~held_out(), rows))
