"""WARC archives: a writer and a splittable reader.

The writer puts one gzip member per record into one file per task, with
payloads that are equal written once and referred to afterwards. The reader
splits archives by byte ranges: a task looks for the gzip magic in its range,
takes a candidate for a member only if it decodes to a WARC header, and owns the
records that start inside its range, however far they reach.

Archives lie in the folder that all executors share. Local paths are opened as
files; other file systems are reached through Arrow.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import new_folder, stored

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range that one reading task scans.
RANGE = 4 << 20
#: Bytes read at a time.
STEP = 1 << 18
#: Compressed bytes that must be enough to see a record's first line.
PROBE = 1 << 12
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
MANIFEST = "file string, n_bytes long"
RECORD = (
    "page_id string, url string, record_type string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary"
)


# ---------------------------------------------------------------- files


def _local(path: str) -> str | None:
    parts = urlsplit(path)
    return parts.path if parts.scheme == "file" else path if not parts.scheme else None


def open_to_read(path: str) -> BinaryIO:
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def put(path: str, name: str, parts: Iterator[bytes]) -> int:
    """Write a file under a name of its own and move it into place: a task that runs again replaces its file."""
    attempt = f"{name}.{uuid.uuid4().hex}.part"
    local, n = _local(path), 0
    if local is not None:
        os.makedirs(local, exist_ok=True)
        with open(f"{local}/{attempt}", "wb") as f:
            for part in parts:
                n += f.write(part)
        os.replace(f"{local}/{attempt}", f"{local}/{name}")
        return n
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(inner, recursive=True)
    with system.open_output_stream(f"{inner}/{attempt}", compression=None) as f:
        for part in parts:
            n += f.write(part)
    system.move(f"{inner}/{attempt}", f"{inner}/{name}")
    return n


# ---------------------------------------------------------------- writing


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member; ``refers_to`` makes it a revisit without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.0",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=';/?:@&=+$,#%[]!*()~')}")
    if refers_to is not None:
        head += [
            f"WARC-Profile: {IDENTICAL}",
            f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, refers_to)}>",
            f"X-Refers-To-Page: {refers_to}",
        ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def members() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
                    yield member(*(v.as_py() for v in row))

        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        n = put(folder, name, members())
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([n])], names=["file", "n_bytes"])

    return write


def write_warc(
    pages: DataFrame, folder: str, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write every row as a record; the manifest (file, n_bytes) comes back.

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with
    the smallest id is the response, rows with other ids are revisits; rows that
    repeat the smallest id are responses again. Rows without an id can not be
    referred to: they are responses if no row of their group has an id. A null
    payload is empty, a null url is left out.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").alias("id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    shared = rows.filter(F.octet_length("payload") >= least_bytes)
    first = shared.groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
    # payloads without a copy need no exchange of their own beyond this join on the digest
    joined = rows.join(first.filter("copies > 1").drop("copies"), "digest", "left")
    refers = F.when(~F.col("first_id").eqNullSafe(F.col("id")), F.col("first_id").cast("string"))
    records = joined.select(F.col("id").cast("string").alias("page_id"), "url", "payload", refers.alias("refers_to"))
    return stored(records.mapInArrow(_writer(folder), MANIFEST), "manifest")


# ---------------------------------------------------------------- reading


class Window:
    """Bytes of a file from a moving start, read in steps."""

    def __init__(self, file: BinaryIO, start: int):
        self.file, self.start, self.data = file, start, b""

    def fill(self, upto: int) -> bool:
        """Have the bytes before ``upto`` at hand; False at the end of the file."""
        while self.start + len(self.data) < upto:
            self.file.seek(self.start + len(self.data))
            more = self.file.read(max(STEP, upto - self.start - len(self.data)))
            if not more:
                return False
            self.data += more
        return True

    def drop(self, upto: int) -> None:
        self.data = self.data[upto - self.start :]
        self.start = upto

    def find(self, what: bytes, start: int, stop: int) -> int:
        """First place at or after ``start`` and before ``stop`` where ``what`` begins, or -1."""
        at = start
        while at < stop:
            self.fill(min(at + STEP, stop) + len(what) - 1)
            last = min(at + STEP, stop)
            found = self.data.find(what, at - self.start, last - self.start + len(what) - 1)
            if found >= 0:
                return self.start + found
            at = last
            self.drop(min(at, self.start + len(self.data)))
        return -1


def opens_record(window: Window, at: int) -> bool:
    """Whether a gzip member that starts here decodes to a WARC version line."""
    window.fill(at + PROBE)
    try:
        seen = zlib.decompressobj(31).decompress(window.data[at - window.start : at - window.start + PROBE], 64)
    except zlib.error:
        return False
    return seen.startswith(b"WARC/")


def read_member(window: Window, at: int) -> tuple[bytes, int]:
    """The member's content and where the next one may start."""
    unpack, out, place = zlib.decompressobj(31), [], at
    while not unpack.eof:
        there = window.fill(place + 1)
        chunk = window.data[place - window.start :]
        if not there and not chunk:
            raise EOFError(f"the archive ends inside the record at {at}")
        out.append(unpack.decompress(chunk))
        place += len(chunk) - len(unpack.unused_data)
        window.drop(place)
    return b"".join(out), place


def records_in_range(file: BinaryIO, start: int, stop: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the records that start in [start, stop)."""
    window, at = Window(file, start), start
    while (at := window.find(MAGIC, at, stop)) >= 0:
        if not opens_record(window, at):
            at += 1
            continue
        content, at = read_member(window, at)
        head, _, block = content.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        yield fields, block[: int(fields["content-length"])]


def parse_record(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    size = len(payload)
    if revisit:
        told = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size = int(told[0]) if told else None
    elif base32_sha1(payload) != digest:
        raise ValueError(f"payload of {fields.get('x-page-id')} does not have its digest {digest}")
    return (
        fields.get("x-page-id"), fields.get("warc-target-uri"), fields["warc-type"], fields.get("x-refers-to-page"),
        digest, size, payload if with_payload and not revisit else None,
    )


def _reader(with_payload: bool):
    types = [pa.string()] * 5 + [pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, stop in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "stop"))):
                with open_to_read(path) as file:
                    rows: list[tuple] = []
                    held = 0
                    for fields, block in records_in_range(file, start, stop):
                        if fields.get("warc-type") in ("response", "revisit"):
                            rows.append(parse_record(fields, block, with_payload))
                            held += len(block) if with_payload else 100
                        if held > RANGE:
                            yield batch_of(rows)
                            rows, held = [], 0
                    yield batch_of(rows)

    return read


def read_warc(spark: SparkSession, manifest: DataFrame, with_payload: bool = True, range_bytes: int = RANGE) -> DataFrame:
    """Response and revisit records of the archives in ``manifest`` (file, n_bytes).

    A damaged payload or an archive cut short is an error. Files without a
    record give no rows. Ids come back as text.
    """
    cut = F.explode(F.sequence(F.lit(0), F.col("n_bytes") - 1, F.lit(range_bytes)))
    ranges = (
        manifest.filter("n_bytes > 0")
        .select("file", "n_bytes", cut.alias("start"))
        .select("file", "start", F.least(F.col("start") + range_bytes, "n_bytes").alias("stop"))
    )
    # ranges are a few bytes each; dealt out anew so that the ranges of a file are read side by side
    return ranges.repartition(max(1, spark.sparkContext.defaultParallelism * 4)).mapInArrow(_reader(with_payload), RECORD)


def archive_and_read(pages: DataFrame, least_bytes: int = 0, with_payload: bool = False, range_bytes: int = RANGE) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read their records back."""
    spark = pages.sparkSession
    manifest = write_warc(pages, new_folder(spark, "warc"), least_bytes)
    return read_warc(spark, manifest, with_payload, range_bytes)
