"""WARC archives: a deterministic sharded writer and a reader.

Pages are range-partitioned by id and sorted, and each shard is one task's. Records are gzip members; a file rolls when its compressed size reaches `roll_bytes`. Headers, record ids and digests are regenerated from the page's id, address and payload, so that a second run over the same shards gives the same bytes. A file is written under a temporary name and renamed; the shard's manifest rows, written by Spark's own committer, name the files that count. Archives go to the shared folder, through pyarrow's file systems where it is not a local path.

Of records with equal payloads of at least `least` bytes the one with the smallest page_id is a response and others are revisits of it; among rows with the same page_id the first in order is the response. Null html is an empty payload, a null url an empty address, a null page_id is kept as such (it comes first). An empty table gives no file. Line breaks in addresses are percent-encoded. Further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import uuid
import zlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import common

ROLL_BYTES = 16 << 20
ROWS_PER_SHARD = 8192
DATE = "2020-01-01T00:00:00Z"
MANIFEST = "shard int, file string, records long, bytes long, sha256 string"
RECORDS = "page_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string, payload binary, verified boolean, file string"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def record_id(page_id, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {copy}')}>"


def record(page_id, url: str, payload: bytes, digest: str, refers_to, revisit: bool, copy: int) -> bytes:
    """One WARC record; extension fields carry the page's id and the payload's length."""
    block = (_HTTP % len(payload)) + (b"" if revisit else payload)
    address = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest, copy)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {address}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Payload-Length: {len(payload)}",
        *([] if page_id is None else [f"X-Page-Id: {page_id}"]),
        *([f"WARC-Refers-To: {record_id(refers_to, digest, 0)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []),
        *([f"X-Refers-To-Page: {refers_to}"] if revisit and refers_to is not None else []),
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _store(path: str):
    """A file system and the path in it."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def decisions(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload occurs more than once. Payloads don't move; a hot payload is counted before the shuffle."""
    seen = pages.select("page_id", F.sha1(F.encode("payload", "utf-8")).alias("digest"), F.octet_length("payload").alias("size")).filter(F.col("size") >= least)
    firsts = seen.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNotNull().alias("some"), "page_id")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    return seen.join(firsts, "digest").select("page_id", "digest", F.col("first.page_id").alias("refers_to")).distinct()


def write(pages: DataFrame, path: str, least: int = 0, roll_bytes: int = ROLL_BYTES, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Writes archives below a folder and returns the manifest."""
    spark = pages.sparkSession
    common.small_batches(spark)
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    bounds = common.bounds_of(rows, "page_id", rows_per_shard)
    told = decisions(rows, least).select("page_id", F.lit("").alias("url"), F.lit("").alias("payload"), "digest", F.lit(0).alias("row"), "refers_to")
    both = told.unionByName(rows.select("*", F.lit(None).cast("string").alias("digest"), F.lit(1).alias("row"), F.lit(None).cast("long").alias("refers_to")))
    dealt = both.withColumn("shard", common.part_of(F.col("page_id"), bounds)).repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "row", "url", "payload")

    def run(batches):
        shard, out, page, told, copies = None, None, object(), {}, Counter()
        for batch in batches:
            for some in common.slices(batch, "payload"):
                for at, page_id, url, payload, digest, row, refers_to in zip(*(some.column(c).to_pylist() for c in ("shard", "page_id", "url", "payload", "digest", "row", "refers_to")), strict=True):
                    if at != shard:
                        if out:
                            yield from out.close()
                        shard, out, page = at, _Shard(path, at, roll_bytes), object()
                    if page_id != page:
                        page, told, copies = page_id, {}, Counter()
                    if row == 0:
                        told[digest] = refers_to
                    else:
                        out.add(page_id, url, payload.encode("utf-8"), told, copies)
        if out:
            yield from out.close()

    class _Shard:
        """Rolling files of one shard."""

        def __init__(self, folder: str, number: int, roll: int):
            self.folder, self.number, self.roll, self.part, self.done = folder, number, roll, 0, []
            self.members: list[bytes] = []
            self.size = 0

        def add(self, page_id, url, payload: bytes, told: dict, copies: Counter) -> None:
            raw = hashlib.sha1(payload)
            digest, key = base64.b32encode(raw.digest()).decode(), raw.hexdigest()
            revisit = key in told and (told[key] != page_id or copies[key] > 0)
            member = gzip.compress(record(page_id, url, payload, digest, told.get(key), revisit, copies[key]), 6, mtime=0)
            copies[key] += 1
            if self.members and self.size + len(member) > self.roll:
                self.commit()
            self.members.append(member)
            self.size += len(member)

        def commit(self) -> None:
            store, root = _store(self.folder)
            name = f"shard-{self.number:06d}-{self.part:05d}.warc.gz"
            temporary = f"{root}/_tmp-{name}-{TaskContext.get().taskAttemptId()}"
            store.create_dir(root, recursive=True)
            data = b"".join(self.members)
            with store.open_output_stream(temporary) as f:
                f.write(data)
            if store.get_file_info(f"{root}/{name}").is_file:  # of a task that failed after this file; some stores don't rename onto a file
                store.delete_file(f"{root}/{name}")
            store.move(temporary, f"{root}/{name}")
            self.done.append((self.number, name, len(self.members), len(data), hashlib.sha256(data).hexdigest()))
            self.members, self.size, self.part = [], 0, self.part + 1

        def close(self):
            if self.members:
                self.commit()
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.done, strict=True), types, strict=True)], names=names)

    manifest = dealt.select("shard", "page_id", "url", "payload", "digest", "row", "refers_to").mapInArrow(run, MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{path}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")


def members(data: bytes):
    """The records of concatenated gzip members. The input is fed in small steps, for what follows a member is copied."""
    view, at = memoryview(data), 0
    while at < len(data):
        engine, raw = zlib.decompressobj(31), []
        while not engine.eof and at < len(data):
            raw.append(engine.decompress(view[at : at + 4096]))
            at += min(4096, len(data) - at) - len(engine.unused_data)
        if not engine.eof:
            raise ValueError("truncated gzip member")
        yield b"".join(raw)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives that the manifest names. `verified`: the block's digest holds, and the payload's where it is there. A file whose bytes or number of records aren't those of the manifest is an error."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest").select("file", "records", "bytes", "sha256")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def run(batches):
        for batch in batches:
            for name, content, records, length, digest_told in zip(*(batch.column(c).to_pylist() for c in ("file", "content", "records", "bytes", "sha256")), strict=True):
                if len(content) != length or hashlib.sha256(content).hexdigest() != digest_told:
                    raise ValueError(f"{name} is not the file that the manifest names")
                out, size, seen = [], 0, 0
                for raw in members(content):
                    seen += 1
                    fields, block = parse(raw)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    good = base64.b32encode(hashlib.sha1(block).digest()).decode() == fields["WARC-Block-Digest"].removeprefix("sha1:")
                    revisit = fields["WARC-Type"] == "revisit"
                    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
                    if payload is not None:
                        good &= base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest and len(payload) == int(fields["X-Payload-Length"])
                    number = lambda k: int(fields[k]) if k in fields else None
                    out.append((number("X-Page-Id"), fields["WARC-Type"], number("X-Refers-To-Page"), fields.get("WARC-Target-URI"), number("X-Payload-Length"), digest, payload, good, name))
                    size += len(block)
                    if size > common.SLICE_CHARS:
                        yield rows(out)
                        out, size = [], 0
                if out:
                    yield rows(out)
                if seen != records:
                    raise ValueError(f"{name} has {seen} records of {records}")

    def rows(out):
        names = [c.split()[0] for c in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return files.join(manifest, "file").select("file", "content", "records", "bytes", "sha256").mapInArrow(run, RECORDS)


def remove(path: str) -> None:
    """Deletes archives of a local folder."""
    import shutil

    shutil.rmtree("/" + path.removeprefix("file:").lstrip("/")) if os.path.isdir("/" + path.removeprefix("file:").lstrip("/")) else None
