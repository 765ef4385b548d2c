"""WARC archives: write, normalise, index and read back.

``write_archives`` gives each task's pages to one archive, compressed as a
whole (one gzip stream).  ``normalise`` inflates such a stream once, front to
back, writes every record as a gzip member of its own and notes offset and
length of each in a sidecar (one JSON object a line), so that single records
can be read.  ``read_archives`` takes the sidecars as a table and reads each
record by its offset.

A page whose payload (the html in UTF-8) has ``SHORTEST`` bytes or more and
equals that of a page with a smaller page_id is a revisit record: its block is
empty, it names the digest, the length and the page it refers to.

The folder must be one that all executors share; it is reached through
``pyarrow.fs``, so a URI of a distributed store works as a local path does.
Files get a temporary name first and the final one once complete, so a task
that is lost or run twice leaves whole archives only.  Memory: a task holds
one page and the compressor's window when writing and normalising.

Cases: a null html is an empty payload.  A null page_id is never the page that
others refer to unless all pages of that payload have none; then all are
responses.  Rows with the same page_id and payload are responses both if none
is smaller.  A null url is left out, other characters are percent-encoded.
Empty tasks write no archive; without any page the result is empty.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize

SHORTEST = 100
PIECE = 1 << 20
URL_SAFE = "%/:?#[]@!$&'()*+,;=~-._"
DATE = "1970-01-01T00:00:00Z"  # the pages carry none
PAGE = "urn:page:"


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def record(page_id: int | None, url: str | None, html: str | None, digest: str, refers_to: int | None, revisit: bool) -> Iterator[bytes]:
    """One WARC record, in pieces."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = [http] if revisit else [http, payload]
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <{PAGE}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=URL_SAFE)}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{PAGE}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {sum(map(len, block))}", "", ""]
    yield "\r\n".join(lines).encode()
    yield from block
    yield b"\r\n\r\n"


def read_header(stream: BinaryIO) -> tuple[bytes, dict[str, str]] | None:
    """The raw header of the next record and its fields; None at the end."""
    raw = stream.readline()
    if not raw:
        return None
    if not raw.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {raw[:40]!r}")
    fields = {}
    while True:
        line = stream.readline()
        raw += line
        if line == b"\r\n":
            return raw, fields
        if not line:
            raise EOFError("the archive ends within a header")
        name, _, value = line.decode().partition(":")
        fields[name.lower()] = value.strip()


def normalise_stream(source: BinaryIO, target: BinaryIO) -> Iterator[dict]:
    """Copy the records of a gzip stream, each as a member of its own; yields
    where each one lies in ``target``."""
    offset = 0
    with gzip.GzipFile(fileobj=source) as plain:
        while (header := read_header(plain)) is not None:
            raw, fields = header
            member, length = zlib.compressobj(wbits=31), 0
            left = int(fields["content-length"]) + 4  # the block and two line ends
            piece = raw
            while True:
                packed = member.compress(piece)
                target.write(packed)
                length += len(packed)
                if not left:
                    break
                piece = plain.read(min(left, PIECE))
                if not piece:
                    raise EOFError("the archive ends within a block")
                left -= len(piece)
            packed = member.flush()
            target.write(packed)
            length += len(packed)
            yield {"offset": offset, "length": length, "record_id": fields.get("warc-record-id"), "type": fields.get("warc-type")}
            offset += length


def read_record(member: bytes) -> dict:
    """page_id, payload size and digest, type and the page referred to, from
    one gzip member.  A response's payload is measured, a revisit's stated."""
    plain = gzip.GzipFile(fileobj=pa.BufferReader(member))
    _, fields = read_header(plain)
    block = plain.read(int(fields["content-length"]))
    head, _, payload = block.partition(b"\r\n\r\n")
    page, other = (x[len(PAGE) + 1:-1] if x else "" for x in (fields["warc-record-id"], fields.get("warc-refers-to")))
    out = {"page_id": int(page) if page else None, "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
           "refers_to": int(other) if other else None}
    if out["record_type"] == "revisit":
        size = int(head.rpartition(b":")[2])  # the last field is the length
        return out | {"payload_bytes": size, "payload_digest": fields["warc-payload-digest"].partition(":")[2]}
    return out | {"payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest()}


def _save(fs: pafs.FileSystem, path: str, write) -> None:
    """Write a file under a name of this attempt, then give it its own; a file
    of that name is replaced in one step where the store can do so."""
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temporary, compression=None) as out:
        write(out)
    try:
        fs.move(temporary, path)
    except OSError:     # a store that moves onto no file: another attempt was faster, with the same records
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            raise
        fs.delete_file(path)
        fs.move(temporary, path)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """One whole-file gzip archive per task under ``folder``; a table of their names."""
    digest = F.sha2(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 256)
    pages = pages.select("page_id", "url", "html", digest.alias("digest"))
    long = F.octet_length(F.coalesce("html", F.lit(""))) >= SHORTEST
    copies = (pages.where(long).groupBy(F.col("digest").alias("_digest"))
              .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    revisit = F.coalesce(F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to")), F.lit(False)) & F.col("refers_to").isNotNull()
    marked = (pages.join(copies, F.col("digest") == F.col("_digest"), "left")
              .select("page_id", "url", "html", "digest", "refers_to", revisit.alias("revisit")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*batch.columns)

        every = rows()
        first = next(every, None)
        if first is None:
            return
        fs, path = _store(f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz")
        fs.create_dir(path.rpartition("/")[0], recursive=True)

        def fill(out: BinaryIO) -> None:
            whole = zlib.compressobj(wbits=31)
            row = first
            while row is not None:
                for piece in record(*(x.as_py() for x in row)):
                    out.write(whole.compress(piece))
                row = next(every, None)
            out.write(whole.flush())

        _save(fs, path, fill)
        yield pa.RecordBatch.from_pylist([{"name": path.rpartition("/")[2]}])

    return materialize(marked.mapInArrow(write, "name string"), "archives")


def normalise(names: DataFrame, source: str, target: str) -> None:
    """Rewrite the archives ``names`` of ``source`` under ``target``, each with its sidecar."""
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, old = _store(f"{source}/{name}")
                _, new = _store(f"{target}/{name}")
                fs.create_dir(new.rpartition("/")[0], recursive=True)

                def fill(out: BinaryIO, name: str = name, old: str = old, new: str = new, fs: pafs.FileSystem = fs) -> None:
                    def index(side: BinaryIO) -> None:
                        with fs.open_input_stream(old, compression=None) as stream:
                            for entry in normalise_stream(stream, out):
                                side.write(json.dumps({"archive": name} | entry).encode() + b"\n")

                    _save(fs, f"{new.removesuffix('.warc.gz')}.index.json", index)

                _save(fs, new, fill)
                yield pa.RecordBatch.from_pylist([{"name": name}])

    n = names.count()
    if n:
        materialize(names.repartition(n).mapInArrow(rewrite, "name string"), "normalised")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the normalised archives under ``folder``, by the sidecars."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != name:
                    fs, path = _store(f"{folder}/{archive}")
                    name, file = archive, fs.open_input_file(path)
                rows.append(read_record(file.read_at(length, offset)))
            yield pa.RecordBatch.from_pylist(rows, schema)

    index = spark.read.schema("archive string, offset long, length long").json(f"{folder}/*.index.json")
    return index.mapInArrow(read, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as archives, normalised and read back: page_id,
    payload_bytes, payload_digest, record_type, refers_to and url."""
    spark = pages.sparkSession
    folder = scratch_path(spark, f"warc/{uuid.uuid4().hex}")
    names = write_archives(pages, f"{folder}/whole")
    normalise(names, f"{folder}/whole", f"{folder}/records")
    if names.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")
    return (read_archives(spark, f"{folder}/records")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"))
