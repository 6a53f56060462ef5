"""Archives: exact round trip, shared payloads, equal files on every run, and only committed files are read."""

import gzip
import hashlib
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sieveline.llm import warc
from sieveline.llm.queries import op2_warc
from sieveline.sources.scratch import scratch_path

BIG = "é" * 600
PAGES = [
    (1, "http://a", "short"),
    (2, "http://b", "short"),
    (3, "http://c\r\nX: y", BIG),
    (9, None, BIG),
    (9, None, BIG),
    (4, "http://d", BIG),
    (None, "http://e", BIG),
    (None, "http://f", "z" * 2000),
    (None, "http://f", "z" * 2000),
    (5, "http://g", None),
    (6, "http://h", ""),
    (7, "http://i", "\r\n\r\nWARC/1.1\r\n" * 90),
    (8, "http://j", "y" * 300_000),
]


def expected(pages):
    """(page_id, bytes, digest, type, refers_to) per page; of repeated rows the first is the response."""
    raw = [(p, (h or "").encode()) for p, _, h in pages]
    keeper = {}
    for p, data in raw:
        if len(data) >= 1000 and p is not None:
            keeper[data] = max(p, keeper.get(data, p))
    times, seen, out = Counter(data for _, data in raw), set(), []
    for p, data in raw:
        k = keeper.get(data) if times[data] > 1 else None
        revisit = k is not None and (p != k or (p, data) in seen)
        seen.add((p, data))
        out.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", k if revisit else None))
    return Counter(out)


def rows(df):
    return Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect())


def files_of(path):
    base = path.removeprefix("file://")
    return {f: open(f"{base}/{f}", "rb").read() for f in sorted(os.listdir(base)) if f.endswith((".gz", ".json"))}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def test_pages(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()
    assert rows(op2_warc(spark, sf_dir)) == expected([tuple(r) for r in table])


def test_awkward_pages(spark, pages):
    path = scratch_path(spark, "test")
    warc.write_archive(pages.withColumn("shard", F.lit("clash")).repartition(4), path, shard_bytes=3000, file_bytes=400)
    back = warc.read_archive(spark, path, payload=True)
    assert rows(back) == expected(PAGES)
    assert {bytes(r["payload"]) for r in back.collect() if r["payload"] is not None} == {(h or "").encode() for _, _, h in PAGES}
    assert len(files_of(path)) > 4


def test_files_do_not_depend_on_partitions(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    made = []
    for parts in (1, 7):
        path = scratch_path(spark, "test")
        warc.write_archive(table.repartition(parts), path, shard_bytes=100_000, file_bytes=20_000)
        made.append(files_of(path))
    assert made[0] == made[1] and len(made[0]) > 5
    manifest = json.loads(made[0].pop(warc.MANIFEST))
    assert [f["name"] for f in manifest["files"]] == list(made[0])
    for f in manifest["files"]:
        assert (f["bytes"], f["sha256"]) == (len(made[0][f["name"]]), hashlib.sha256(made[0][f["name"]]).hexdigest())
        assert f["bytes"] < 20_000 + 30_000


def test_only_committed_files_are_read(spark, pages):
    path = scratch_path(spark, "test")
    warc.write_archive(pages, path)
    base = path.removeprefix("file://")
    for stray in ("part-999999-00000.warc.gz", "_temporary/x-part-000000-00000.warc.gz"):
        with open(f"{base}/{stray}", "wb") as out:
            out.write(b"cut off")
    assert rows(warc.read_archive(spark, path)) == expected(PAGES)


def test_a_changed_payload_is_noticed(spark, pages):
    path = scratch_path(spark, "test")
    warc.write_archive(pages.where("page_id = 1"), path)
    base = path.removeprefix("file://")
    name = next(f for f in os.listdir(base) if f.endswith(".gz"))
    data = gzip.decompress(open(f"{base}/{name}", "rb").read()).replace(b"short", b"shOrt")
    with open(f"{base}/{name}", "wb") as out:
        out.write(gzip.compress(data))
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(spark, path).collect()


def test_empty(spark, pages):
    path = scratch_path(spark, "test")
    warc.write_archive(pages.where("page_id > 99"), path)
    assert warc.read_archive(spark, path).collect() == []
