"""WARC archives: writing, normalising monolithic gzip files, reading back by offset (operator 9).

``write_archives`` writes each task's records as one whole-file gzip stream. ``normalise_archives`` inflates
every such file once, as a stream, rewrites each record as a gzip member of its own and writes a sidecar
index (record id, offset, compressed length) beside it. ``read_archives`` opens members at indexed offsets.

Defined results: a null html is an empty payload; a null or unusable url leaves out the target line; line
breaks in a url are percent-encoded; equal payloads of at least ``MIN_REVISIT`` bytes have one response record
(smallest page_id; rows that share it are all responses) and revisits that name it, rows with a null page_id among them; payloads that only
rows without an id hold, and smaller ones, are all responses; every row is written; an empty table gives archives without records; other columns are ignored.

Files are written under a temporary name and renamed when whole; a task that runs again writes the same names.
"""

from __future__ import annotations

import hashlib
import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import prepare, small_or_not, staged

MIN_REVISIT = 100
FILE_BYTES = 64 << 20  # a task starts another file after this much record text
CHUNK = 1 << 18
BROADCAST_REVISITS = 200_000  # revisits (about 150 bytes each) that are broadcast at most; more join by a shuffle
DATE = "2025-01-01T00:00:00Z"
FILES = "path string, records bigint, bytes bigint"
INDEX = "path string, record_id string, offset bigint, length bigint"
RECORDS = ("page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint, digest_matches boolean")
_SPACE = re.compile(r"[\x00-\x20\x7f]")


def _files(path: str):
    """File system and plain path of a folder that executors share: a mounted one, or any that Arrow opens."""
    if "://" in path and not path.startswith("file:"):
        from pyarrow.fs import FileSystem

        return FileSystem.from_uri(path)
    from pyarrow.fs import LocalFileSystem

    return LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to): digests choose the response of equal payloads.

    Digests alone are grouped (with a map-side minimum), and what goes back to a page is its response's id. Payloads
    move only if there are more than BROADCAST_REVISITS revisits.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    large = rows.where(F.col("payload_bytes") >= MIN_REVISIT).select("page_id", "payload_digest")
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    shared = staged(first.where("n > 1 and first_id is not null"), "responses")
    again = (large.join(shared, "payload_digest").where("page_id > first_id")
             .groupBy("page_id").agg(F.map_from_entries(F.collect_set(F.struct("payload_digest", "first_id"))).alias("firsts")))
    known = rows.where("page_id is not null")
    named = known.join(small_or_not(staged(again, "revisits"), BROADCAST_REVISITS), "page_id", "left").select(*rows.columns, F.col("firsts")[F.col("payload_digest")].alias("refers_to"))
    # rows without an id come last: by their digests, as no id tells them apart
    by_digest = small_or_not(shared.select(F.col("payload_digest").alias("of"), F.col("first_id").alias("refers_to")), BROADCAST_REVISITS)
    nameless = rows.where("page_id is null").join(by_digest, F.col("payload_digest") == F.col("of"), "left").select(*rows.columns, "refers_to")
    return named.unionByName(nameless)


def _record_id(page_id) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit carries the response's HTTP head, but no payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_record_id(page_id)}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None and _usable(url):
        head.append("WARC-Target-URI: " + _SPACE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{_record_id(refers_to)}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _usable(url: str) -> bool:
    try:
        return bool(urlsplit(url).scheme)
    except ValueError:
        return False


class _Whole:
    """A file that has its name only once it is whole."""

    def __init__(self, fs, path: str):
        self.fs, self.path, self.temp = fs, path, f"{path}.{uuid.uuid4().hex}.tmp"
        self.out = fs.open_output_stream(self.temp, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.temp, self.path)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _files(folder)
        part, n, out, plain, records, made = TaskContext.get().partitionId(), 0, None, 0, 0, []

        def close() -> None:
            nonlocal out
            out.write(gzip.flush())
            out.close()
            made.append({"path": os.path.basename(out.path), "records": records, "bytes": out.size})
            out = None

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    out, gzip, plain, records = _Whole(fs, f"{top}/part-{part:06d}-{n:04d}.warc.gz"), zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
                    n += 1
                data = record_bytes(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["refers_to"])
                out.write(gzip.compress(data))
                plain, records = plain + len(data), records + 1
                if plain >= FILE_BYTES:
                    close()
        if out is not None:
            close()
        if made:
            yield pa.RecordBatch.from_pylist(made, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))
    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` as monolithic ``.warc.gz`` files into ``folder`` (shared by all executors); FILES of what
    the finished tasks wrote."""
    spark = pages.sparkSession
    prepare(spark)
    fs, top = _files(folder)
    fs.create_dir(f"{top}/monolithic")
    listing = f"{folder}/monolithic-files"
    with_revisits(pages).mapInArrow(_write(f"{folder}/monolithic"), FILES).write.parquet(listing)
    return spark.read.schema(FILES).parquet(listing)


class _Inflated(io.RawIOBase):
    """Bytes of a gzip file, inflated chunk by chunk as they are asked for; one stream or many members."""

    def __init__(self, source):
        self.source, self.gzip, self.rest = source, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            if self.gzip.eof:
                self.rest = self.gzip.unused_data or self.source.read(CHUNK)
                if not self.rest:
                    return 0
                self.gzip = zlib.decompressobj(31)
            data = self.gzip.decompress(self.rest or self.source.read(CHUNK), len(into))
            self.rest = self.gzip.unconsumed_tail
            if data:
                into[:len(data)] = data
                return len(data)
            if not self.rest and not self.gzip.eof and self.source.tell() == self.source.size():
                raise EOFError("the gzip stream is cut off")


def records(stream: io.BufferedIOBase) -> Iterator[tuple[bytes, dict[str, str], bytes]]:
    """(raw record, header, block) one after the other; a cut or malformed record is an error."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not start with its version line")
        raw, header = [line], {}
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise EOFError("a record's header is cut off")
            raw.append(line)
            name, _, value = line.decode().partition(":")
            header[name.strip().lower()] = value.strip()
        raw.append(line)
        size = int(header["content-length"])
        block = stream.read(size)
        end = stream.read(4)
        if len(block) < size or end != b"\r\n\r\n":
            raise EOFError("a record's block is cut off")
        yield b"".join([*raw, block, end]), header, block


def _normalise(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _files(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out, index = _Whole(fs, f"{top}/members/{name}"), []
                with fs.open_input_file(f"{top}/monolithic/{name}") as f:
                    for raw, header, _ in records(io.BufferedReader(_Inflated(f), CHUNK)):
                        gzip = zlib.compressobj(6, zlib.DEFLATED, 31)
                        at = out.size
                        out.write(gzip.compress(raw) + gzip.flush())
                        index.append({"path": name, "record_id": header["warc-record-id"].strip("<>"), "offset": at, "length": out.size - at})
                out.close()
                side = _Whole(fs, f"{top}/members/{name}.idx")
                side.write("".join(f"{r['offset']} {r['length']} {r['record_id']}\n" for r in index).encode())
                side.close()
                for i in range(0, len(index), 10_000):
                    yield pa.RecordBatch.from_pylist(index[i:i + 10_000], pa.schema([("path", pa.string()), ("record_id", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
    return run


def normalise_archives(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Rewrite each monolithic file of ``files`` with one gzip member per record and a sidecar ``.idx``; the INDEX."""
    fs, top = _files(folder)
    fs.create_dir(f"{top}/members")
    listing = f"{folder}/member-index"
    # a task per file: the listing is tiny, and adaptive execution would put all of it into one
    files.select("path").repartition(max(1, files.count())).mapInArrow(_normalise(folder), INDEX).write.parquet(listing)
    return spark.read.schema(INDEX).parquet(listing)


def parse_member(data: bytes) -> dict:
    """One record of a member: its page's id, payload and what the header says of it."""
    _, header, block = next(records(io.BytesIO(data)))
    page_id = header["warc-record-id"].strip("<>").removeprefix("urn:page:")
    head, _, payload = block.partition(b"\r\n\r\n")
    refers = header.get("warc-refers-to", "").strip("<>").removeprefix("urn:page:")
    size = int(re.search(rb"(?m)^Content-Length: (\d+)", head)[1])
    digest = header["warc-payload-digest"].removeprefix("sha256:")
    response = header["warc-type"] == "response"
    matches = len(payload) == size and hashlib.sha256(payload).hexdigest() == digest if response else None
    if matches is False:
        raise ValueError(f"the payload of page {page_id} is not what its record says")
    return {"page_id": int(page_id) if page_id else None, "url": header.get("warc-target-uri"), "payload": payload if response else None,
            "payload_bytes": size, "payload_digest": digest, "record_type": header["warc-type"], "refers_to": int(refers) if refers else None, "digest_matches": matches}


def _read(folder: str, with_payload: bool):
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("digest_matches", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _files(folder)
        name, f = None, None
        for batch in batches:
            out, size = [], 0
            for path, at, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if path != name:
                    if f:
                        f.close()
                    name, f = path, fs.open_input_file(f"{top}/members/{path}")
                f.seek(at)
                row = parse_member(zlib.decompress(f.read(length), 31))
                size += len(row["payload"] or b"")
                if not with_payload:
                    row["payload"] = None
                out.append(row)
                if size > 16 << 20:
                    yield pa.RecordBatch.from_pylist(out, fields)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, fields)
        if f:
            f.close()
    return run


def read_archives(folder: str, index: DataFrame, with_payload: bool = True) -> DataFrame:
    """RECORDS read from the members that ``index`` points at. Responses are checked against their digest."""
    files = max(1, index.select("path").distinct().count())
    members = index.select("path", "offset", "length").repartition(files, "path").sortWithinPartitions("path", "offset")
    return members.mapInArrow(_read(folder, with_payload), RECORDS)


def archived_pages(pages: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Write ``pages``, normalise the archives, read them back."""
    files = write_archives(pages, folder)
    return read_archives(folder, normalise_archives(pages.sparkSession, folder, files), with_payload)
