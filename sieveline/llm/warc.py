"""Deterministic sharded WARC archives: written and read as a Spark data source.

Records are laid out by page id in contiguous shards of near-equal size, each shard rolls its files by compressed
size, and headers and digests are made anew from the payloads. Tasks write under temporary names; the
commit renames the files of the successful attempts and publishes a manifest, which is all that readers look at. Names and contents depend
on the pages alone, not on partitions, attempts or the time of day.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from sieveline.functions.buckets import with_buckets
from sieveline.llm.sharding import contiguous_shards
from sieveline.sources.scratch import written

#: Payloads from this size on are stored once.
LEAST_SHARED = 1000
#: Payload bytes in a shard, and compressed bytes after which a file is closed.
SHARD_BYTES, FILE_BYTES = 64 << 20, 16 << 20
LEVEL = 4
#: The date of every record: the pages carry none, and archives must not differ between runs.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (file, hdfs, s3, gs) or a plain local path."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{copy}')}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", base32_sha1(block)), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in lines), "\r\n"]).encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, copy: int, refers_to: int | None, revisit: bool) -> bytes:
    """A response with the payload, or a revisit with the HTTP header alone."""
    digest = hashlib.sha1(payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest.hexdigest(), copy)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest.digest()).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        headers.insert(2, ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest.hexdigest(), 0)), ("X-Refers-To-Page", str(refers_to))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return record(headers, http.encode() + (b"" if revisit else payload))


@dataclass
class Files(WriterCommitMessage):
    """What one task attempt has written."""

    files: list[dict] = field(default_factory=list)


class RollingFile:
    """The files of one shard: each is closed once it has ``limit`` compressed bytes."""

    def __init__(self, root: str, shard: int, limit: int, level: int, attempt: str):
        self.root, self.shard, self.limit, self.level, self.attempt = root, shard, limit, level, attempt
        self.store, self.base = filesystem(root)
        self.done: list[dict] = []
        self.out, self.size, self.records = None, 0, 0

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.temporary = f"_temporary/{self.attempt}-{self.name}"
            self.out = self.store.open_output_stream(f"{self.base}/{self.temporary}", compression=None)
            self.check, self.size, self.records = hashlib.sha256(), 0, 0
            self.put(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.name, 0)), ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self.put(data)
        self.records += 1
        if self.size >= self.limit:
            self.close()

    def put(self, data: bytes) -> None:
        member = gzip.compress(data, self.level, mtime=0)  # a member per record, so readers can start at any of them
        self.out.write(member)
        self.check.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append({"name": self.name, "temporary": self.temporary, "bytes": self.size, "records": self.records, "sha256": self.check.hexdigest()})


class WarcWriter(DataSourceArrowWriter):
    """Takes rows of (shard, page_id, digest, kind, refers_to, url, html) in that order; see :func:`laid_out`."""

    def __init__(self, options: dict):
        self.path, self.level, self.limit = options["path"], int(options.get("level", LEVEL)), int(options.get("filebytes", FILE_BYTES))
        store, base = filesystem(self.path)
        store.create_dir(f"{base}/_temporary", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        attempt = uuid.uuid4().hex
        files, rolling, shard, key, copy, mark = [], None, None, None, 0, None
        for batch in iterator:
            for row in (r for k in range(0, batch.num_rows, 64) for r in batch.slice(k, 64).to_pylist()):
                if rolling is None or row["shard"] != shard:
                    if rolling:
                        rolling.close()
                        files += rolling.done
                    shard = row["shard"]
                    rolling = RollingFile(self.path, shard, self.limit, self.level, attempt)
                if (row["page_id"], row["digest"]) != key:
                    key, copy, mark = (row["page_id"], row["digest"]), 0, None
                if row["kind"] == 0:  # the mark of this page comes before the page
                    mark = row["refers_to"]
                    continue
                # a mark with the page's own id: its first row is the response, repeated rows revisit it
                revisit = mark is not None and (mark != row["page_id"] or copy > 0)
                rolling.add(page_record(row["page_id"], row["url"], (row["html"] or "").encode(), copy, mark, revisit))
                copy += 1
        if rolling:
            rolling.close()
            files += rolling.done
        return Files(files)

    def commit(self, messages: list[Files | None]) -> None:
        store, base = filesystem(self.path)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f["name"])
        for f in files:
            store.move(f"{base}/{f.pop('temporary')}", f"{base}/{f['name']}")
        with store.open_output_stream(f"{base}/_temporary/{MANIFEST}", compression=None) as out:
            out.write(json.dumps({"files": files}, indent=1).encode())
        store.move(f"{base}/_temporary/{MANIFEST}", f"{base}/{MANIFEST}")

    def abort(self, messages: list[Files | None]) -> None:
        store, base = filesystem(self.path)
        for f in (f for m in messages if m for f in m.files):
            if store.get_file_info(path := f"{base}/{f['temporary']}").type == fs.FileType.File:
                store.delete_file(path)


READ_SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
READ_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def records_of(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed WARC stream."""
    while version := stream.readline():
        if version.strip() == b"":
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        headers = {}
        while (line := stream.readline().decode().rstrip("\r\n")) != "":
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if base32_sha1(block) != headers["warc-block-digest"]:
            raise ValueError(f"block digest of {headers['warc-record-id']} does not hold")
        yield headers, block


def page_row(headers: dict[str, str], block: bytes, payload: bool) -> dict | None:
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, body = block.partition(b"\r\n\r\n")
    digest = headers["warc-payload-digest"]
    if kind == "response" and base32_sha1(body) != digest:
        raise ValueError(f"payload digest of {headers['warc-record-id']} does not hold")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    row = {
        "page_id": int(headers["x-page-id"]) if "x-page-id" in headers else None,
        "url": headers.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": length,
        "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex(),
        "refers_to": int(headers["x-refers-to-page"]) if kind == "revisit" else None,
    }
    return row | {"payload": body if kind == "response" else None} if payload else row


class WarcReader(DataSourceReader):
    """A partition per file of the manifest; files that no manifest lists are not read."""

    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "false") == "true"

    def partitions(self) -> list[InputPartition]:
        store, base = filesystem(self.path)
        with store.open_input_stream(f"{base}/{MANIFEST}", compression=None) as file:
            return [InputPartition(f["name"]) for f in json.loads(file.read())["files"]]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an archive without files
            return
        store, base = filesystem(self.path)
        schema = READ_ARROW.append(pa.field("payload", pa.binary())) if self.payload else READ_ARROW
        with store.open_input_stream(f"{base}/{partition.value}", compression=None) as file, gzip.open(file) as stream:
            rows = []
            for headers, block in records_of(stream):
                if (row := page_row(headers, block, self.payload)) is not None:
                    rows.append(row)
                if len(rows) == 1000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    """Format ``warc``. Options: ``path``; writing: ``level``, ``fileBytes``; reading: ``payload`` to get the payloads too."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA + (", payload binary" if self.options.get("payload", "false") == "true" else "")

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter({k.lower(): v for k, v in self.options.items()})


def laid_out(pages: DataFrame, id: str, url: str, html: str, shard_bytes: int) -> DataFrame:
    """Pages and, before each page of a shared payload, a mark with the page to refer to; dealt and sorted by shard.

    Payloads are shuffled once. What decides about a record travels as narrow marks in the same shuffle. Pages with
    a null id are spread over the shards by digest.
    """
    content = F.coalesce(F.col(html), F.lit("")).cast("binary")
    digest = F.sha1(content)
    facts = written(
        pages.select(F.col(id).cast("long").alias("page_id"), digest.alias("digest"), F.octet_length(content).cast("long").alias("size")), "digests"
    )
    total = facts.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    sizes = facts.where(F.col("page_id").isNotNull()).select("page_id", (F.col("size") + 1).alias("size"))
    starts = contiguous_shards(sizes, ["page_id"], "size", shards).groupBy("shard").agg(F.min("page_id").alias("first"))
    # one number per shard; as any monotone function of the id serves, doubles do
    cuts = sorted({float(r["first"]) for r in starts.where(F.col("shard") > 0).collect()})
    shared = (
        facts.where(F.col("size") >= LEAST_SHARED)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("refers_to").isNotNull())
        .drop("n")
    )
    marks = facts.where(F.col("size") >= LEAST_SHARED).select("page_id", "digest").join(shared, "digest").distinct()
    none = F.lit(None)
    rows = pages.select(
        F.col(id).cast("long").alias("page_id"), digest.alias("digest"), F.lit(1).alias("kind"), none.cast("long").alias("refers_to"), F.col(url).cast("string").alias("url"), F.col(html).alias("html")
    ).unionByName(
        marks.select("page_id", "digest", F.lit(0).alias("kind"), "refers_to", none.cast("string").alias("url"), none.cast("string").alias("html"))
    )
    spread = F.pmod(F.xxhash64("digest"), F.lit(len(cuts) + 1)).cast("int")
    dealt = with_buckets(rows.withColumn("_id", F.col("page_id").cast("double")), {"_bucket": ("_id", cuts)})
    placed = dealt.withColumn("shard", F.when(F.col("page_id").isNull(), spread).otherwise(F.col("_bucket").cast("int")))
    return (
        placed.select("shard", "page_id", "digest", "kind", "refers_to", "url", "html")
        .repartition("shard")
        .sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "digest", "kind", "url")
    )


def write_archive(
    pages: DataFrame,
    path: str,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write one record per row of ``pages`` below ``path``, which must not hold an archive yet.

    The payload is the html in UTF-8 (null: empty). Of rows with equal payloads of at least 1000 bytes the one with the largest id
    is a response and the others revisit it; all shorter ones are responses. Of repeated rows with that id, one is the
    response. Rows with a null id revisit like others, but nothing refers to them: if no row of a payload has an id, all
    are responses. An empty table gives a manifest without files. Other columns are not read.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    rows = laid_out(pages, id, url, html, shard_bytes)
    rows.write.format("warc").option("fileBytes", file_bytes).mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The pages of an archive: ``page_id, url, record_type, payload_bytes, payload_digest, refers_to`` and, if asked for,
    ``payload`` (null for revisits). Every block and payload digest is checked."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
