import gzip
import hashlib
import os

import pytest

from tavola.llm import warc


@pytest.fixture()
def pages(spark):
    big = "q" * 150
    rows = [
        (1, "u", big), (2, None, big), (2, "b", big), (None, None, big), (None, "z", None), (5, "u\nx", "short"),
        (6, "u", "short"), (7, "a", None), (-9, "z", "é" * 100), (1 << 60, "z", "é" * 100), (8, "l", "x" * 300_000),
        (-(1 << 63), "lo", "low"), ((1 << 63) - 1, "hi", "high"),
    ]
    return spark.createDataFrame([(*r, "more") for r in rows], "page_id long, url string, html string, digest string")


def rows_of(frame):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in frame.collect()), key=str)


def test_round_trip(spark, pages):
    payloads = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    least = {}
    for i, p in payloads:
        if i is not None:
            least[p] = min(least.get(p, i), i)
    expected, given = [], set()
    for i, p in sorted(payloads, key=lambda x: (x[0] is not None, x[0] or 0)):
        revisit = len(p) >= 100 and p in least and (i != least[p] or (i, p) in given)
        given.add((i, p))
        kind, to = ("revisit", least[p]) if revisit else ("response", None)
        expected.append((i, len(p), hashlib.sha256(p).hexdigest(), kind, to))
    for limits in ({}, {"shard_bytes": 20_000, "file_bytes": 100}):
        assert rows_of(warc.round_trip(pages, **limits)) == sorted(expected, key=str)


def test_files_roll_are_equal_and_are_whole_archives(spark, pages, tmp_path):
    found = []
    for name in ("a", "b"):
        folder = f"file://{tmp_path}/{name}"
        manifest = warc.write_warc(pages.repartition(3 if name == "a" else 5), folder, 20_000, 100).collect()
        files = sorted(os.listdir(tmp_path / name))
        assert files == sorted(os.path.basename(r["path"]) for r in manifest)
        found.append({f: open(tmp_path / name / f, "rb").read() for f in files})
        for r in manifest:
            data = found[-1][os.path.basename(r["path"])]
            assert (r["bytes"], r["sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
            plain = gzip.decompress(data)
            assert plain.startswith(b"WARC/1.1\r\n") and plain.count(b"WARC-Record-ID: ") == r["records"]
    assert found[0] == found[1] and len(found[0]) > 5
    ids = [x for data in found[0].values() for x in gzip.decompress(data).split(b"\r\n") if x.startswith(b"WARC-Record-ID")]
    assert len(ids) == len(set(ids))


def test_a_damaged_block_is_noticed(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/c"
    manifest = warc.write_warc(pages, folder)
    for row in manifest.collect():
        path = row["path"]
        with open(path, "rb") as file:
            plain = gzip.decompress(file.read())
        if b"short" in plain:
            break
    with open(path, "wb") as file:
        file.write(gzip.compress(plain.replace(b"short", b"shirt", 1)))
    with pytest.raises(Exception):
        warc.read_warc(manifest, folder).collect()


def test_empty_table(spark, pages):
    assert warc.round_trip(pages.limit(0)).collect() == []
