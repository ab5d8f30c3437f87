"""WARC archives of pages: a distributed writer and a sequential reader.

Writing: every page becomes one record, every record one gzip member.  Of pages with
equal payloads (SHA-1 of the UTF-8 html; the empty payload too) the one with the
largest page_id is a ``response``, the others are ``revisit`` records that refer to
it and carry only its HTTP header.  A partition writes archives of about
``archive_bytes`` each: to a scratch name first, then renamed, in page order, so a
task that runs again replaces its files by the same ones.

Reading: Spark hands out archives; each is read front to back.  ``zlib`` inflates one
member at a time in small steps, the block is framed by Content-Length, block and
payload digests are recomputed and must match.

Defined results: null html is the empty payload; null url is an empty target; a page
without page_id is written with its url and read back with a null page_id, and never
the target of a revisit unless all equal pages lack one; rows that repeat page_id and
html are each written, all as response when theirs is the largest page_id.
"""

from __future__ import annotations

import base64
import hashlib
import io
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir, id_text, text_or_empty

READ_STEP = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("record_id string, page_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary, archive string")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: str) -> str:
    return f"<urn:x-page:{page_id}>"


def _page_id(urn: str | None) -> int | None:
    head, _, tail = (urn or "").strip("<>").rpartition(":")
    return int(tail) if head == "urn:x-page" else None


def _clean(value: str) -> str:
    """A header value: controls and spaces of a URL are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def encode_record(page_id: str | None, url: str, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    """One gzip member that holds one WARC/1.1 record."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    digest = sha1_base32(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_urn(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, url + digest)}>'}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {_clean(url)}",
            "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}"] + ([f"WARC-Refers-To: {_urn(refers_to)}"] if refers_to is not None else [])
    head.append(f"Content-Length: {len(block)}")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def members(stream: io.BufferedIOBase) -> Iterator[bytes]:
    """The inflated gzip members of ``stream``, one after the other."""
    data, inflate, out = stream.read(READ_STEP), None, []
    while data:
        if inflate is None:
            inflate, out = zlib.decompressobj(31), []
        out.append(inflate.decompress(data))
        if inflate.eof:
            yield b"".join(out)
            data, inflate = inflate.unused_data, None
        else:
            data = b""
        data = data or stream.read(READ_STEP)
    if inflate is not None:
        raise ValueError("archive ends inside a gzip member")


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one record; wrong framing or digests raise ValueError."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(h["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("Content-Length does not frame the block")
    if h["warc-block-digest"] != "sha1:" + sha1_base32(block):
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in
              (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    full = int(fields["content-length"])
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    response = h["warc-type"] == "response"
    if response and (len(payload) != full or sha1_base32(payload) != digest):
        raise ValueError("payload digest differs")
    return {"record_id": h["warc-record-id"], "page_id": _page_id(h["warc-record-id"]), "url": h["warc-target-uri"],
            "record_type": h["warc-type"], "refers_to": _page_id(h.get("warc-refers-to")), "payload_bytes": full,
            "payload_digest": digest, "payload": payload if response else None}


def write_archives(pages: DataFrame, root: str, archive_bytes: int = 32 << 20) -> str:
    """Write ``pages`` (page_id, url, html) as ``root``/archives/*.warc.gz; returns that folder.

    ``root`` must be reachable from every executor (a URI that pyarrow's file systems open)."""
    folder = f"{root.rstrip('/')}/archives"
    rows = pages.select("page_id", text_or_empty("url").alias("url"), text_or_empty("html").alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    # digests that occur once need no partner; the maximum combines before the shuffle
    groups = (rows.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").drop("n"))
    # joined on a second key too: the rows get an exchange of their own, which adaptive execution
    # can split where one payload is that of many pages
    k = F.xxhash64("digest").alias("k")
    rows = (rows.select("*", k).join(groups.select("*", k), ["k", "digest"], "left")
            .withColumn("revisit", F.coalesce(F.col("page_id") != F.col("last"),
                                              F.col("page_id").isNull() & F.col("last").isNotNull()))
            .select("page_id", "url", "html", id_text("last").alias("last"), "revisit")
            .sortWithinPartitions("page_id", "url", F.xxhash64("html"))
            .withColumn("page_id", id_text("page_id")))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part, ctx = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        made, out, tmp, size, count = [], None, None, 0, 0

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                name = f"part-{part:06d}-{len(made):05d}.warc.gz"
                store.move(tmp, posixpath.join(base, name))
                made.append((name, count, size))
                out = None
        for pdf in batches:
            for page_id, url, html, last, revisit in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["last"], pdf["revisit"]):
                record = encode_record(page_id, url, html.encode("utf-8", "replace"),
                                       last, bool(revisit))
                if out is not None and size + len(record) > archive_bytes:
                    close()
                if out is None:
                    tmp, size, count = posixpath.join(base, f"_{part}-{ctx}-{len(made)}"), 0, 0
                    out = store.open_output_stream(tmp, compression=None)
                out.write(record)
                size, count = size + len(record), count + 1
        close()
        yield pd.DataFrame(made, columns=["archive", "records", "bytes"])

    (rows.mapInPandas(write, "archive string, records long, bytes long")
     .write.mode("overwrite").parquet(f"{root.rstrip('/')}/manifest"))
    from pyarrow import fs
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)         # without pages no task has made it
    return folder


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Every record of ``folder``/*.warc.gz, digests verified; ``payload=False`` leaves payloads out of the rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "content")

    def read(batches: Iterator) -> Iterator:
        cols = [f.split()[0] for f in RECORDS.split(", ")]
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for raw in members(io.BytesIO(content.as_buffer())):
                    rows.append(parse_record(raw) | {"archive": posixpath.basename(path.as_py())})
                    held += len(raw)
                    if not payload:
                        rows[-1]["payload"] = None
                    if held > (4 << 20):
                        yield from _frames(rows, cols)
                        rows, held = [], 0
                yield from _frames(rows, cols)

    return files.mapInArrow(read, RECORDS)


def _frames(rows: list[dict], cols: list[str]):
    import pyarrow as pa
    kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in cols], cols)


def round_trip(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back, without payloads."""
    spark = pages.sparkSession
    root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read_archives(spark, write_archives(pages, root), payload=False)
