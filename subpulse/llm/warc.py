"""WARC archives with a Zstandard dictionary: written and read by tasks.

Every archive starts with a skippable frame that holds a dictionary built from
records of the archive itself; each record follows as a frame of its own,
compressed with that dictionary, so any record can be read alone. Pages whose
payload another page has too become revisit records that refer to it.

Tasks write below the shared folder (``spark.checkpoint.dir``), whatever file
system that is, under names no other attempt uses. The table of archives lists
only those of tasks that succeeded, and only these are read.

Defined results: a NULL html is an empty payload, and empty payloads are equal;
a NULL url leaves its header out; rows that repeat the largest page id of a
payload are all responses; pages without an id revisit a page that has one, and
are responses if there is none. An empty table gives no archives and no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subpulse.llm.common import lookup
from subpulse.session import scratch_path, settle

# fixed values of the formats
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1.1\r\n"

DICTIONARY_BYTES, LEVEL = 1 << 16, 6
#: The records that a dictionary is built from: the first of an archive, up to so many and so many bytes.
SAMPLE_RECORDS, SAMPLE_BYTES = 2000, 8 << 20
ARCHIVE_BYTES = 128 << 20
DATE = "2024-01-01T00:00:00Z"
READ = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "url string, payload binary, archive string")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(record: str) -> int | None:
    text = record.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response with its payload or, if it refers to another page, a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
            "Content-Type: application/http;msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return VERSION + "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of READ but the archive; a payload that differs from its digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    claimed = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if fields["WARC-Type"] == "response" and (base32_sha1(payload) != claimed or len(payload) != size):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload differs from its digest")
    refers_to = fields.get("WARC-Refers-To")
    return {"page_id": _page(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": claimed,
            "record_type": fields["WARC-Type"], "refers_to": _page(refers_to) if refers_to else None,
            "url": fields.get("WARC-Target-URI"), "payload": payload if refers_to is None else None}


def build_dictionary(records: list[bytes]) -> bytes:
    """A trained dictionary, or the records themselves where there are too few to train."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICTIONARY_BYTES]


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


class _Archive:
    """Collects the records of the sample, then writes them and all later ones."""

    def __init__(self, folder: str):
        self.files, self.place = _folder(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.waiting, self.waiting_bytes, self.records, self.out = [], 0, 0, None

    def add(self, record: bytes) -> bool:
        """False when the archive is full."""
        self.records += 1
        if self.out is not None:
            self.out.write(self.compressor.compress(record))
            return self.out.tell() < ARCHIVE_BYTES
        self.waiting.append(record)
        self.waiting_bytes += len(record)
        if len(self.waiting) >= SAMPLE_RECORDS or self.waiting_bytes >= SAMPLE_BYTES:
            self._open()
        return True

    def _open(self) -> None:
        dictionary = build_dictionary(self.waiting)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
        self.files.create_dir(self.place, recursive=True)
        self.out = self.files.open_output_stream(f"{self.place}/{self.name}", compression=None)
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
        for record in self.waiting:
            self.out.write(self.compressor.compress(record))
        self.waiting = []

    def close(self) -> tuple[str, int]:
        if self.out is None:
            self._open()
        self.out.close()
        return self.name, self.records


def read_archive(source) -> Iterator[bytes]:
    """The records of an open archive, one frame after another."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not start with a dictionary")
    dictionary = zstandard.ZstdDecompressor().decompress(source.read(size))
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    rest = source.read(1 << 16)
    while rest:
        frame, parts = reader.decompressobj(), []
        while rest and not frame.eof:
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else source.read(1 << 16)
        if not frame.eof:
            raise ValueError("the archive ends inside a record")
        yield b"".join(parts)
        rest = rest or source.read(1 << 16)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): of equal payloads the page with the largest id keeps its payload."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    digests = settle(rows.select("page_id", "digest"), "payloads")
    groups = settle(digests.groupBy("digest").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("pages")),
                    "payload-groups")
    refers = F.when((F.octet_length("payload") >= least_bytes) & F.col("largest").isNotNull()
                    & ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return lookup(rows, groups, "digest", digests.count(), "pages").select(
        "page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write ``with_revisits`` rows; the settled table (archive, records) of what was written."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*batch.columns, strict=True):
                archive = archive or _Archive(folder)
                if not archive.add(build_record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py())):
                    done, archive = [*done, archive.close()], None
        if archive:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_pydict({"archive": [n for n, _ in done],
                                              "records": pa.array([r for _, r in done], pa.int64())})

    return settle(records.select("page_id", "url", "payload", "refers_to").mapInArrow(
        write, "archive string, records long"), "archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record, with the payload of responses."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = _folder(folder)
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                            ("payload", pa.binary()), ("archive", pa.string())])
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{place}/{name}", compression=None) as source:
                    for raw in read_archive(source):
                        rows.append(parse_record(raw) | {"archive": name})
                        size += len(raw)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    spread = archives.repartition(max(1, archives.count()), "archive")
    return spread.mapInArrow(read, READ)


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
