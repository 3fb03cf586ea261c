"""Token ids in Arrow stream files of equal-length sequences, and random access to them.

Documents in ascending order of doc_id (nulls first, then by text) form one long run of ids,
each document ending with ``end_id``. The run is dealt in ranges of ids to shards. A shard has
two files in the Arrow stream format: ``.tokens.arrow`` holds rows of ``length`` ids as a
fixed-size list, with a mask as a fixed-size list of the same length (false only where the
last sequence of a shard is padded); ``.docs.arrow`` holds doc_id and n_tokens of its documents
in order. Neither is compressed, and all lists of a batch lie side by side, so a reader that
maps the file gets any sequence without a copy: the manifest lists where each batch begins.

Files are written under a name of the attempt and renamed when complete. Ids take 16 bits when
the vocabulary allows, else 32. A missing text is an empty one and has the end id alone;
repeated rows are documents of their own; an empty table writes nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import public_tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tavola.llm.pieces import PieceIds, texts_and_ids
from tavola.llm.resident import resident
from tavola.llm.shared import new_folder, stored

MANIFEST = "shard long, tokens_path string, docs_path string, n_docs long, n_tokens long, batches array<long>"
READ = "shard long, doc_id long, local_start long, n_tokens long, ids_crc32 long"
#: Sequences per batch.
ROWS = 256


def cut(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes between ASCII white space, without it; a full stop or comma that ends a
    run after an ASCII letter or digit is a piece of its own. A-Z are lowered in ASCII runs."""
    n = len(data)
    if not n:
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(n + 1, dtype=bool)
    edge[ends] = True
    edge[0] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    if n > 1:
        lower = data | 32
        named = ((lower >= 97) & (lower <= 122)) | ((data >= 48) & (data <= 57))
        closes = np.append(~solid[1:] | edge[1:n], True)
        stop = ((data == 46) | (data == 44)) & closes
        stop[1:] &= named[:-1] & ~edge[1:n]
        stop[0] = False
        begins |= stop
    first = np.flatnonzero(begins)
    row = np.searchsorted(ends, first, side="right")
    kept = data[solid]
    place = np.cumsum(solid)
    piece_ends = np.append(place[first[1:]] - 1, len(kept)) if len(first) else first
    if len(first):
        starts = np.concatenate([[0], piece_ends[:-1]])
        wide = np.maximum.reduceat(kept, starts) > 127
        upper = (kept >= 65) & (kept <= 90) & ~np.repeat(wide, piece_ends - starts)
        kept = kept + (upper * np.uint8(32))
    return kept, piece_ends, row


def _byte_letters() -> dict[int, str]:
    """What a byte-level vocabulary writes for the bytes that are not printable Latin-1."""
    others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: chr(256 + k) for k, b in enumerate(others)}


class Library:
    """Ids by the tokenizers library, piece by piece."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.special = sorted(
            t.content for t in self.tokenizer.get_added_tokens_decoder().values()
        )

    def pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """A run of Latin-1 letters is one word to the tokenizer, whose model is asked at once;
        any other piece goes through the whole tokenizer."""
        out: list[list[int] | None] = [None] * len(pieces)
        rest = []
        for k, piece in enumerate(pieces):
            word = piece.decode()
            if word.isalpha() and max(word) <= "\xff":
                plain = word.lower().encode().decode("latin-1").translate(self.letters)
                out[k] = [token.id for token in self.model.tokenize(plain)]
            else:
                rest.append(k)
        coded = self.tokenizer.encode_batch_fast(
            [pieces[k].decode() for k in rest], add_special_tokens=False
        )
        for k, encoding in zip(rest, coded):
            out[k] = encoding.ids
        return out

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def _library(path: str) -> tuple[Library, PieceIds]:
    def build() -> tuple[Library, PieceIds]:
        library = Library(path)
        return library, PieceIds(library.pieces)

    return resident(("library", path), build)


def encode_texts(texts: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids of each text in turn."""
    library, known = _library(path)
    texts = texts.cast(pa.large_string()).fill_null("")
    marked = np.zeros(len(texts), dtype=bool)
    for token in library.special:
        marked |= pa.compute.match_substring(texts, token).to_numpy(zero_copy_only=False)
    for first, ends, ids in texts_and_ids(texts, cut, known):
        start = 0
        for k, end in enumerate(ends.tolist()):
            if marked[first + k]:
                yield np.array(library.whole(texts[first + k].as_py()), dtype=np.int32)
            else:
                yield ids[start:end]
            start = end


class _Shard:
    """Writes the two files of a shard; a sequence at a time is held back."""

    def __init__(self, folder: str, shard: int, length: int, width: pa.DataType) -> None:
        self.files, root = fs.FileSystem.from_uri(folder)
        self.files.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        self.shard, self.length, self.width = shard, length, width
        self.paths = [f"{root}/{shard:08d}.{kind}.arrow" for kind in ("tokens", "docs")]
        self.temporary = [f"{path}.{attempt}.tmp" for path in self.paths]
        self.sinks = [self.files.open_output_stream(p, compression=None) for p in self.temporary]
        self.schema = token_schema(length, width)
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
        self.tokens = pa.ipc.new_stream(self.sinks[0], self.schema)
        # the schema message goes out with the first batch: let that be an empty one
        self.tokens.write_batch(pa.RecordBatch.from_pylist([], schema=self.schema))
        self.docs = pa.ipc.new_stream(self.sinks[1], self.docs_schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_docs = self.n_tokens = 0
        self.batches: list[int] = []

    def add(self, doc_ids: list, ids: list[np.ndarray]) -> None:
        counts = [len(x) for x in ids]
        self.docs.write_batch(
            pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64())], schema=self.docs_schema)
        )
        self.n_docs += len(ids)
        self.n_tokens += sum(counts)
        self.held += ids
        self.n_held += sum(counts)
        if self.n_held >= ROWS * self.length:
            flat = np.concatenate(self.held)
            full = len(flat) // (ROWS * self.length) * ROWS * self.length
            for at in range(0, full, ROWS * self.length):
                self._write(flat[at : at + ROWS * self.length], ROWS * self.length)
            self.held, self.n_held = [flat[full:]], len(flat) - full

    def _write(self, flat: np.ndarray, real: int) -> None:
        mask = np.arange(len(flat)) < real
        self.batches.append(self.sinks[0].tell())
        self.tokens.write_batch(
            pa.record_batch(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(flat, self.width), self.length),
                    pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
                ],
                schema=self.schema,
            )
        )

    def close(self) -> dict:
        if self.n_held:
            flat = np.concatenate(self.held)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, dtype=flat.dtype)
            padded[: len(flat)] = flat
            self._write(padded, len(flat))
        self.tokens.close()
        self.docs.close()
        for sink, temporary, path in zip(self.sinks, self.temporary, self.paths):
            sink.close()
            self.files.move(temporary, path)
        return {
            "shard": self.shard,
            "tokens_path": self.paths[0],
            "docs_path": self.paths[1],
            "n_docs": self.n_docs,
            "n_tokens": self.n_tokens,
            "batches": self.batches,
        }


def token_schema(length: int, width: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(width, length)), ("mask", pa.list_(pa.bool_(), length))])


def _writer(folder: str, path: str, length: int, end_id: int, narrow: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("shard", pa.int64()), ("tokens_path", pa.string()), ("docs_path", pa.string()),
             ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("batches", pa.list_(pa.int64()))]
        )
        width, kind = (pa.uint16(), np.uint16) if narrow else (pa.uint32(), np.uint32)
        shard = None
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                if shard is None:
                    shard = _Shard(folder, TaskContext.get().partitionId(), length, width)
                ids = [
                    np.append(x, end_id).astype(kind) for x in encode_texts(batch.column("text"), path)
                ]
                shard.add(batch.column("doc_id").to_pylist(), ids)
        rows = [shard.close()] if shard else []
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def write_tokens(
    docs: DataFrame, folder: str, path: str | None = None, length: int = 1024, end_id: int = 1
) -> DataFrame:
    """Write the ids of ``docs`` under ``folder`` and return the manifest, a row per shard.

    Shards follow each other in the order of their number.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    narrow = max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16
    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return stored(ranged.mapInArrow(_writer(folder, path, length, end_id, narrow), MANIFEST), "manifest")


class Sequences:
    """Random access to the sequences of a shard; mapped, so without a copy, where files are local."""

    def __init__(self, folder: str, tokens_path: str, batches: list[int]) -> None:
        files, _ = fs.FileSystem.from_uri(folder)
        local = isinstance(files, fs.LocalFileSystem)
        self.source = pa.memory_map(tokens_path) if local else files.open_input_file(tokens_path)
        self.schema = pa.ipc.open_stream(self.source).schema
        self.batches = batches

    def batch(self, k: int) -> pa.RecordBatch:
        self.source.seek(self.batches[k])
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``k`` of the shard."""
        batch, row = self.batch(k // ROWS), k % ROWS
        return (
            batch.column("ids")[row].values.to_numpy(),
            batch.column("mask")[row].values.to_numpy(zero_copy_only=False),
        )


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for entry in batch.to_pylist():
                sequences = Sequences(folder, entry["tokens_path"], entry["batches"])
                source = _real_ids(sequences)
                left, start = np.zeros(0, np.uint32), 0
                with files.open_input_stream(entry["docs_path"], compression=None) as stream:
                    for docs in pa.ipc.open_stream(stream):
                        counts = docs.column("n_tokens").to_pylist()
                        sums = []
                        for n in counts:
                            crc = 0
                            while n:
                                if not len(left):
                                    left = next(source)
                                crc = zlib.crc32(left[:n].tobytes(), crc)
                                n, left = n - min(n, len(left)), left[n:]
                            sums.append(crc)
                        ends = start + np.cumsum(counts, dtype=np.int64)
                        yield pa.record_batch(
                            [
                                pa.array([entry["shard"]] * len(counts), pa.int64()),
                                docs.column("doc_id"),
                                pa.array(ends - counts),
                                docs.column("n_tokens"),
                                pa.array(sums, pa.int64()),
                            ],
                            names=["shard", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                        )
                        start = int(ends[-1]) if len(ends) else start

    return run


def _real_ids(sequences: Sequences) -> Iterator[np.ndarray]:
    """The ids of a shard without padding, as little-endian 32-bit, batch by batch."""
    for k in range(len(sequences.batches)):
        batch = sequences.batch(k)
        ids = batch.column("ids").flatten().to_numpy()
        mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
        yield ids[mask].astype("<u4")


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone.

    The start adds the ids of all shards before: the manifest has one row per shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = manifest.select(
        F.col("shard").alias("of"), F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before")
    )
    shards = max(1, manifest.count())
    rows = manifest.repartitionByRange(shards, "shard").mapInArrow(_reader(folder), READ)
    return rows.join(F.broadcast(offsets), F.col("shard") == F.col("of")).select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, path: str | None = None, length: int = 1024) -> DataFrame:
    """Write ``docs`` to a new folder of the shared one and read the files back."""
    folder = new_folder(docs.sparkSession, "tokens")
    return read_documents(write_tokens(docs, folder, path, length), folder)
