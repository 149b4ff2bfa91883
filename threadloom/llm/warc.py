"""WARC archives: one gzip member per record, written by tasks and read back sequentially.

Records of equal long payloads are stored once; the others become revisit records
that refer to it. The reader inflates incrementally, frames every block by its content length and
verifies the digests, so it needs a constant amount of memory whatever the records' sizes.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.files import atomic_output, open_input
from threadloom.sources.stages import scratch_path

MIN_SHARED_BYTES = 1000
FILE_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"
SALTS = 16
_CHUNK = 64 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_ID = "urn:page:"


# --- records ----------------------------------------------------------------
def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(head.encode()) + deflate.compress(block) + deflate.compress(b"\r\n\r\n") + deflate.flush()


def _base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _uri(url: str | None, page_id: int | None) -> str:
    """A header value without blanks or control characters, whatever the table holds."""
    if url:
        return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")
    return f"urn:url-of-page:{'' if page_id is None else page_id}"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<{_RECORD_ID}{'' if page_id is None else page_id}:{digest}>"


def _page_of(record_id: str) -> int | None:
    number = record_id.strip("<>").removeprefix(_RECORD_ID).partition(":")[0]
    return int(number) if number else None


def info_record() -> bytes:
    block = b"software: threadloom\r\nformat: WARC File Format 1.1\r\n"
    return _member(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:warcinfo>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
        block,
    )


def page_record(row: dict) -> bytes:
    """The record of a row ``page_id, url, html, digest, bytes, refers_to, refers_url``; html is
    only wanted when ``refers_to`` is null."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    revisit = row["refers_to"] is not None
    block = http if revisit else http + (row["html"] or "").encode()
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(row["page_id"], row["digest"])),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _uri(row["url"], row["page_id"])),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _base32(row["digest"])),
        ("WARC-Block-Digest", _base32(hashlib.sha1(block).hexdigest())),
    ]
    if revisit:
        headers += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", _record_id(row["refers_to"], row["digest"])),
            ("WARC-Refers-To-Target-URI", _uri(row["refers_url"], row["refers_to"])),
        ]
    return _member(headers, block)


# --- sequential reader ------------------------------------------------------
@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str] = field(default_factory=dict)
    payload_bytes: int = 0  # found in the archive, so 0 for a revisit
    payload_digest: str | None = None  # lower-case hex of what was found


class WarcReader:
    """Iterates over the records of a stream of gzip members and checks each of them."""

    def __init__(self, stream, keep_payload: bool = False):
        self.stream = stream
        self.keep_payload = keep_payload
        self.payload = b""  # of the last record, if kept
        self._compressed = b""

    def _begin(self) -> bool:
        """Start the next member; false at the end of the stream."""
        self._compressed = self._compressed or self.stream.read(_CHUNK)
        self._inflate = zlib.decompressobj(31)
        self._plain = b""
        return bool(self._compressed)

    def _more(self) -> bool:
        """Inflate at most one more chunk of the current member."""
        if self._inflate.eof:
            return False
        data = self._inflate.unconsumed_tail or self._compressed or self.stream.read(_CHUNK)
        if not data:
            raise EOFError("the archive ends within a record")
        self._compressed = b""
        self._plain += self._inflate.decompress(data, _CHUNK)
        if self._inflate.eof:
            self._compressed = self._inflate.unused_data
        return True

    def _line(self) -> bytes:
        while b"\r\n" not in self._plain:
            if not self._more():
                raise ValueError("a record without a complete header")
        line, _, self._plain = self._plain.partition(b"\r\n")
        return line

    def _take(self, n: int) -> bytes:
        """Between one byte and ``n`` bytes of the member."""
        while not self._plain:
            if not self._more():
                raise EOFError("a block shorter than its content length")
        part, self._plain = self._plain[:n], self._plain[n:]
        return part

    def _fields(self) -> dict[str, str]:
        fields = {}
        while line := self._line():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        return fields

    def __iter__(self) -> Iterator[Record]:
        while self._begin():
            if not self._line().startswith(b"WARC/1."):
                raise ValueError("a member that is not a WARC record")
            record = Record(self._fields())
            self._block(record)
            yield record

    def _block(self, record: Record) -> None:
        left = int(record.headers["content-length"])
        whole, payload = hashlib.sha1(), hashlib.sha1()
        in_http = record.headers["content-type"].startswith("application/http")
        head = b""
        kept = []
        while left:
            part = self._take(left)
            left -= len(part)
            whole.update(part)
            if in_http:
                head += part
                text, end, part = head.partition(b"\r\n\r\n")
                if not end:
                    continue
                in_http = False
                for line in text.decode().split("\r\n")[1:]:
                    name, _, value = line.partition(":")
                    record.http[name.strip().lower()] = value.strip()
            payload.update(part)
            record.payload_bytes += len(part)
            if self.keep_payload:
                kept.append(part)
        self.payload = b"".join(kept)
        tail = b""
        while self._plain or self._more():
            tail, self._plain = tail + self._plain, b""
        if tail != b"\r\n\r\n":
            raise ValueError("a record that does not end after its content length")
        record.payload_digest = payload.hexdigest()
        self._verify(record, whole.hexdigest())

    @staticmethod
    def _verify(record: Record, block_digest: str) -> None:
        said = record.headers.get("warc-block-digest")
        if said is not None and said != _base32(block_digest):
            raise ValueError("a block that does not match its digest")
        said = record.headers.get("warc-payload-digest")
        if record.headers["warc-type"] == "response":
            if said != _base32(record.payload_digest):
                raise ValueError("a payload that does not match its digest")
            if int(record.http["content-length"]) != record.payload_bytes:
                raise ValueError("a payload that does not match its length")


# --- Spark side -------------------------------------------------------------
def plan_records(pages: DataFrame, min_shared_bytes: int = MIN_SHARED_BYTES) -> DataFrame:
    """``page_id, url, html, digest, bytes, refers_to, refers_url``: html is null for revisits.

    The owner of each shared payload is found by a combined maximum per digest; only digests that
    occur twice go to the join, whose hot digests are dealt over salts on both sides.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).select(
        "*",
        F.sha1(F.col("html").cast("binary")).alias("digest"),
        F.octet_length("html").cast("long").alias("bytes"),
        F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).alias("_salt"),
    )
    owners = (
        rows.where(F.col("bytes") >= min_shared_bytes)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("_n"), F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("_own"))
        .where((F.col("_n") > 1) & F.col("_own").isNotNull())
        .select("digest", "_own", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    )
    revisit = F.col("_own").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_own.page_id"))
    return rows.join(owners, ["digest", "_salt"], "left").select(
        "page_id",
        "url",
        F.when(~revisit, F.col("html")).alias("html"),
        "digest",
        "bytes",
        F.when(revisit, F.col("_own.page_id")).alias("refers_to"),
        F.when(revisit, F.col("_own.url")).alias("refers_url"),
    )


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` to ``folder``; returns the written table of paths."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        rows = (row for batch in batches for start in range(0, len(batch), 256) for row in batch.slice(start, 256).to_pylist())
        row = next(rows, None)
        number = 0
        while row is not None:
            path = f"{folder}/pages-{partition:06d}-{number:04d}.warc.gz"
            records, size = 0, 0
            with atomic_output(path) as out:
                out.write(info_record())
                while row is not None and size < file_bytes:
                    size += out.write(page_record(row))
                    records += 1
                    row = next(rows, None)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64())], ["path", "records"])
            number += 1

    plan_records(pages).mapInArrow(write, "path string, records long").write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema("path string, records long").parquet(f"{folder}/manifest")


def read_archives(paths: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page record."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with open_input(path) as stream:
                    for record in WarcReader(stream):
                        h = record.headers
                        if h["warc-type"] == "warcinfo":
                            continue
                        refers = h.get("warc-refers-to")
                        rows.append((
                            _page_of(h["warc-record-id"]),
                            int(record.http["content-length"]),
                            base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex(),
                            h["warc-type"],
                            None if refers is None else _page_of(refers),
                        ))
                columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, (_, kind) in zip(columns, kinds, strict=True)], [n for n, _ in kinds]
                )

    files = paths.select("path").repartition(paths.sparkSession.sparkContext.defaultParallelism, "path")
    return files.mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive ``pages(page_id, url, html)`` under ``folder`` (shared scratch by default) and read it back.

    A null html is an empty payload, a null url gets a urn. Of rows with equal payloads of at
    least 1000 bytes those with the largest ``page_id`` are responses, the rest revisits; rows
    of null id revisit like others, and if all ids of a payload are null, all are responses. An empty table
    gives no rows; other columns are not read.
    """
    folder = folder or scratch_path(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, folder))
