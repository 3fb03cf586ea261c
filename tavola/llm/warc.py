"""WARC archives: one record per page, written in range-sorted shards and read back.

Records are sorted by page_id (nulls first), then by digest and url. Shards are ranges of ids of
about ``shard_bytes`` payload bytes, found from exact byte counts, so the same rows give the
same shards whatever the cluster. Each task writes its shard as gzip
members, one per record, and rolls to a new file once the file has ``file_bytes`` compressed
bytes. Headers and digests are computed anew from the payload. A file is written under a name
of its attempt and renamed when complete; only files that the manifest lists count, and the
manifest is itself committed by Spark's writer. An attempt that is lost leaves a file that the
manifest does not name.

Payload: the html in UTF-8; a missing html is empty. Among records of the same payload of at
least ``revisit_bytes`` bytes, the one with the smallest page_id is a response and the others
are revisits that refer to it and hold no payload. With rows that repeat a page_id, the first
one in the order above is the response and the others refer to the same id. A payload that
occurs only without page_id has no record to refer to: its records are responses. A missing url
is written as an empty target. An empty table writes an empty manifest.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.llm.shared import new_folder, stored

#: A fixed date keeps archives equal from run to run; the table has no time of capture.
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "shard long, file long, path string, records long, bytes long, sha256 string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _text(value: str | None) -> str:
    """A header value: one line without control characters."""
    return "".join(c if c >= " " and c != "\x7f" else "%{:02X}".format(ord(c)) for c in value or "")


def record_id(page_id: int | None, digest: str, kind: str, repeat: int) -> str:
    """Equal for equal records; ``repeat`` counts records of the same page and payload."""
    identity = hashlib.sha256(f"{page_id}|{digest}|{kind}|{repeat}".encode()).hexdigest()
    return f"<urn:uuid:{uuid.UUID(identity[:32])}>"


def record(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    digest: str,
    refers_to: int | None,
    repeat: int = 0,
) -> bytes:
    """One WARC record as a gzip member. ``payload`` is left out of a revisit."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    headers = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, digest, kind, repeat)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_text(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        headers.append(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        headers.append(f"WARC-Refers-To: {record_id(refers_to, digest, 'response', 0)}")
        headers.append(f"X-Refers-To-Page-ID: {refers_to}")
    plain = "\r\n".join(headers).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(plain) + packer.flush()


class _Shard:
    """Writes the files of one shard, one after another, in the order of its records."""

    def __init__(self, folder: str, shard: int | None, file_bytes: int, attempt: int) -> None:
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.file_bytes, self.attempt = shard, file_bytes, attempt
        # names in the order of ids; records without an id come first
        self.name = "0" * 20 if shard is None else f"{shard + (1 << 63) + 1:020d}"
        self.number, self.out, self.done = 0, None, []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.temporary = f"{self.root}/.{self.name}-{self.number:05d}.{self.attempt}.tmp"
            self.files.create_dir(self.root, recursive=True)
            self.out = self.files.open_output_stream(self.temporary, compression=None)
            self.records, self.bytes, self.sum = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.records += 1
        self.bytes += len(member)
        self.sum.update(member)
        if self.bytes >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        # equal records give equal files: a second attempt replaces like with like
        path = f"{self.root}/{self.name}-{self.number:05d}.warc.gz"
        self.files.move(self.temporary, path)
        self.done.append((self.shard, self.number, path, self.records, self.bytes, self.sum.hexdigest()))
        self.number += 1


def _writer(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("shard", pa.int64()), ("file", pa.int64()), ("path", pa.string()),
             ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]
        )
        attempt = TaskContext.get().taskAttemptId()
        open_shard, refers, before, repeat, done = None, None, None, 0, []
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            columns = [batch.column(n).to_pylist() for n in ("shard", "page_id", "url", "digest", "first", "html")]
            for shard, page_id, url, digest, first, html in zip(*columns):
                if digest is not None and html is None and first is not None:
                    refers = (shard, page_id, digest, first)  # a note that stands before its rows
                    continue
                if open_shard is None or open_shard.shard != shard:
                    if open_shard is not None:
                        open_shard.close()
                        done += open_shard.done
                    open_shard, before = _Shard(folder, shard, file_bytes, attempt), None
                to = None
                if refers is not None and refers[:3] == (shard, page_id, digest):
                    to = refers[3]
                    if to == page_id and before != (page_id, digest):
                        to = None  # the response itself
                repeat = repeat + 1 if before == (page_id, digest) else 0
                open_shard.add(record(page_id, url, html, digest, to, repeat))
                before = (page_id, digest)
        if open_shard is not None:
            open_shard.close()
            done += open_shard.done
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in done], schema=schema)

    return run


def _floor_to(width: str) -> Column:
    """The greatest id not above page_id that is a number of widths above ``shard``; ids may lie
    further apart than a long can say."""
    far = "(cast(page_id as decimal(20,0)) - cast(shard as decimal(20,0)))"
    return F.expr(f"cast(shard + cast({far} div {width} as decimal(20,0)) * {width} as long)")


def _dealer(sized: DataFrame, shard_bytes: int) -> tuple[Callable[[DataFrame], DataFrame], int]:
    """What adds ``shard``, the first id of a row's shard, to rows with a page_id; the number of
    shards to expect.

    Shards are equally wide ranges of ids, as many as the bytes ask for, so that a row's shard
    is plain arithmetic. Where ids are uneven, a range of more than four times ``shard_bytes``
    is cut again, from its least to its greatest id and by its own bytes, all such ranges at
    once, until none is left or they hold one id each.
    """
    low, high, total = sized.agg(F.min("page_id"), F.max("page_id"), F.sum("bytes")).first()
    if low is None:
        return lambda rows: rows.withColumn("shard", F.lit(None).cast("long")), 1
    expected = -(-(total or 1) // shard_bytes)
    width = -(-(high - low + 1) // max(1, expected))
    # ids may lie further apart than a long can say
    first, step = (F.lit(str(n)).cast("decimal(20,0)") for n in (low, width))
    levels: list[DataFrame] = []

    def deal(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_width", step).withColumn("shard", first)
        rows = rows.withColumn("shard", _floor_to("_width"))
        for heavy in levels:
            rows = (
                rows.join(heavy, rows["shard"].eqNullSafe(heavy["_heavy"]), "left")
                .withColumn("_width", F.coalesce("_finer", "_width"))
                .withColumn("shard", F.coalesce("_base", "shard"))
                .withColumn("shard", F.when(F.col("_finer").isNull(), F.col("shard")).otherwise(_floor_to("_width")))
                .drop("_heavy", "_base", "_finer")
            )
        return rows

    while len(levels) < 64:
        heavy = (
            deal(sized)
            .where("shard is not null")
            .groupBy("shard")
            .agg(F.sum("bytes").alias("bytes"), F.min("page_id").alias("_base"), F.max("page_id").alias("top"))
            .where((F.col("bytes") > 4 * shard_bytes) & (F.col("top") > F.col("_base")))
            .select(
                F.col("shard").alias("_heavy"),
                "_base",
                F.expr(
                    "cast((cast(top as decimal(20,0)) - cast(_base as decimal(20,0)))"
                    f" div ceil(bytes / {shard_bytes}) + 1 as decimal(20,0))"
                ).alias("_finer"),
            )
        )
        heavy = stored(heavy, "heavy")
        if heavy.isEmpty():
            break
        levels.append(heavy)
    return (lambda rows: deal(rows).drop("_width")), int(expected)


def write_warc(
    pages: DataFrame,
    folder: str,
    shard_bytes: int = 64 << 20,
    file_bytes: int = 16 << 20,
    revisit_bytes: int = 100,
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``folder`` and return the manifest.

    The manifest has a row per file: shard, file, path, records, bytes and sha256.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    light = stored(
        pages.select(
            F.col("page_id").cast("long").alias("page_id"),
            F.sha2(html, 256).alias("digest"),
            F.octet_length(html).cast("long").alias("bytes"),
        ),
        "digests",
    )
    deal, expected = _dealer(light, shard_bytes)
    twice = (
        light.where(F.col("bytes") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .select("digest", "first")
    )
    # a note for each row of a repeated payload travels beside the rows: the payloads move once
    notes = light.join(twice, "digest").distinct().select(
        "page_id", F.lit(None).cast("string").alias("url"), "digest", "first", F.lit(None).cast("binary").alias("html")
    )
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.sha2(html, 256).alias("digest"),
        F.lit(None).cast("long").alias("first"),
        html.alias("html"),
    )
    order = [
        F.col("shard").asc_nulls_first(),
        F.col("page_id").asc_nulls_first(),
        "digest",
        F.col("first").asc_nulls_last(),
        F.col("url").asc_nulls_first(),
    ]
    sent = deal(rows.unionByName(notes)).repartition(expected + 1, "shard").sortWithinPartitions(*order)
    return stored(sent.mapInArrow(_writer(folder, file_bytes), MANIFEST), "manifest")


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a stream of gzip members."""
    unpacker, plain = zlib.decompressobj(31), []
    for chunk in chunks:
        while chunk:
            plain.append(unpacker.decompress(chunk))
            chunk = unpacker.unused_data
            if unpacker.eof:
                rest = b"".join(plain)
                while rest:  # one record in our files; a member may hold more
                    head, _, rest = rest.partition(b"\r\n\r\n")
                    lines = head.decode().split("\r\n")
                    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
                    size = int(headers["Content-Length"])
                    yield headers, rest[:size]
                    rest = rest[size + 4 :]
                unpacker, plain = zlib.decompressobj(31), []


def _chunks(path: str, files: fs.FileSystem) -> Iterator[bytes]:
    with files.open_input_stream(path, compression=None) as stream:
        while chunk := stream.read(1 << 20):
            yield chunk


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(folder)
        names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        schema = pa.schema(
            [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64())]
        )
        for batch in batches:
            for path, count in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                out, seen = [], 0
                for headers, block in records(_chunks(path, files)):
                    digest = hashlib.sha256(block).hexdigest()
                    if headers["WARC-Block-Digest"] != f"sha256:{digest}":
                        raise ValueError(f"a block of {path} does not match its digest")
                    seen += 1
                    response = headers["WARC-Type"] == "response"
                    out.append((
                        int(headers["X-Page-ID"]) if headers["X-Page-ID"] else None,
                        len(block) if response else int(headers["X-Payload-Length"]),
                        digest if response else headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                        headers["WARC-Type"],
                        None if response else int(headers["X-Refers-To-Page-ID"]),
                    ))
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema)
                        out = []
                if seen != count:
                    raise ValueError(f"{path} holds {seen} records of {count}")
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema)

    return run


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the files in ``manifest``, files dealt evenly to tasks."""
    n = max(1, manifest.count())
    return manifest.select("path", "records").repartitionByRange(n, "path").mapInArrow(_reader(folder), READ)


def round_trip(pages: DataFrame, **limits: int) -> DataFrame:
    """Write ``pages`` to a new folder of the shared one and read the archives back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, folder, **limits), folder)


#: DuckDB SQL for the rows of ``round_trip``, for a table of distinct page ids.
SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
