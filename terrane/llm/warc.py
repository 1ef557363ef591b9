"""WARC archives: one gzip member a record, written and read back sequentially.

The writer puts a `response` record for a payload and a `revisit` record (headers only) for a row whose payload another
record carries. The reader feeds a file to an incremental zlib decompressor in small pieces, frames each record by its
Content-Length, and verifies block and payload digests; it holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._bytes import as_binary, tidy
from terrane.llm._shared import partitions, shared_dir, small_batches

PIECE = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """A record that breaks its framing or a digest."""


def sha1_base32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, level: int = 4) -> bytes:
    """One gzip member. With refers_to it is a revisit: it keeps the HTTP header, whose Content-Length is the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {clean}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: {sha1_base32(payload)}", f"WARC-Block-Digest: {sha1_base32(block)}", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def members(stream) -> Iterator[bytes]:
    """The decompressed bytes of each gzip member of a file object, read in pieces."""
    unpack, out, rest = zlib.decompressobj(31), [], b""
    began = False
    while True:
        piece = rest or stream.read(PIECE)
        rest = b""
        if not piece:
            if began:
                raise WarcError("the file ends inside a gzip member")
            return
        try:
            out.append(unpack.decompress(piece))
        except zlib.error as e:
            raise WarcError(f"broken gzip member: {e}") from e
        began = True
        if unpack.eof:
            yield b"".join(out)
            rest, unpack, out, began = unpack.unused_data, zlib.decompressobj(31), [], False


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in small letters) and the block, which Content-Length frames and two line ends close."""
    top, gap, rest = member.partition(b"\r\n\r\n")
    lines = top.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise WarcError("no WARC header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields.get("content-length", -1))
    if n < 0 or rest[n:] != b"\r\n\r\n":
        raise WarcError("Content-Length doesn't frame the record")
    return fields, rest[:n]


def read_file(path: str) -> Iterator[dict]:
    """Verified records of one archive, in order."""
    with open(path, "rb") as stream:
        for member in members(stream):
            fields, block = parse(member)
            if sha1_base32(block) != fields["warc-block-digest"]:
                raise WarcError("block digest differs")
            http, _, payload = block.partition(b"\r\n\r\n")
            size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            kind = fields["warc-type"]
            if kind == "response" and (len(payload) != size or sha1_base32(payload) != fields["warc-payload-digest"]):
                raise WarcError("payload digest differs")
            number = [None if f is None or f == "<urn:page:null>" else int(f[len("<urn:page:") : -1]) for f in (fields["warc-record-id"], fields.get("warc-refers-to"))]
            yield {"page_id": number[0], "url": fields["warc-target-uri"], "record_type": kind, "refers_to": number[1], "payload_bytes": size, "payload_digest": base64.b32decode(fields["warc-payload-digest"][5:]).hex(), "payload": payload if kind == "response" else None}


def _local(directory: str) -> str:
    parsed = urlparse(directory)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"archives are files: {directory} isn't on a file system that executors mount")
    return unquote(parsed.path)


def link_revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html", least: int = 1000) -> DataFrame:
    """page_id, url, payload (null: empty) and refers_to: of rows with equal payloads of at least `least` bytes, that
    with the largest page_id carries it, and the others refer to it. Rows that repeat that largest id carry it too; a null
    id is below every number. The groups are pre-aggregated; only those of several rows are joined."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col("url").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    groups = rows.where(F.length("payload") >= least).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1 and last is not null").drop("n")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("last")), F.lit(None)).otherwise(F.col("last"))
    return rows.join(groups, "digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write(linked: DataFrame, directory: str) -> DataFrame:
    """One archive a task, below a folder that all executors mount. Returns path and record count of each archive.

    A file appears under its name only when it is whole, so a task that runs again replaces it."""
    folder = _local(directory)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        part, n = f"{name}.{os.getpid()}.{TaskContext.get().taskAttemptId()}", 0
        os.makedirs(folder, exist_ok=True)
        with open(part, "wb") as f:
            for b in batches:
                ids, urls, refers = (b.column(c).to_pylist() for c in ("page_id", "url", "refers_to"))
                for i, payload in enumerate(as_binary(b.column("payload"))):
                    f.write(record(ids[i], urls[i], payload.as_py(), refers[i]))
                    n += 1
        os.replace(part, name)
        yield pa.RecordBatch.from_pydict({"path": [name], "n_records": [n]}, pa.schema([("path", pa.string()), ("n_records", pa.int64())]))

    manifest = shared_dir(linked.sparkSession, "warc-manifest")
    linked.mapInArrow(tidy(work), "path string, n_records long").write.parquet(manifest)
    return linked.sparkSession.read.schema("path string, n_records long").parquet(manifest)


RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def read(archives: DataFrame, payloads: bool = True, batch_bytes: int = 4 << 20) -> DataFrame:
    """All records of the archives listed in column path, in tasks of their own."""
    schema = RECORD if payloads else RECORD.remove(len(RECORD) - 1)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for path in b.column("path").to_pylist():
                for r in read_file(path):
                    size += 200 + (len(r["payload"] or b"") if payloads else 0)
                    held.append(r if payloads else {k: v for k, v in r.items() if k != "payload"})
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    names = {"int64": "long", "string": "string", "binary": "binary"}
    return archives.select("path").repartition(4 * partitions(archives.sparkSession)).mapInArrow(tidy(work), ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema))
