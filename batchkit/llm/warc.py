"""WARC archives in Zstandard: written and read record by record, with a shared dictionary.

An archive begins with a skippable frame that holds the dictionary; then every record is a frame of its own. A payload
that occurred before, by its SHA-256, is a revisit of the record that holds it.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchkit.llm.files import created, new_name, opened
from batchkit.llm.sampling import first_texts
from batchkit.session import land, scratch_path

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_BYTES = 1000  # smaller payloads are never revisits
ARCHIVE_BYTES = 32 << 20  # compressed size from which a task begins another archive
SAMPLE_PAGES = 200  # pages the dictionary is made from
SAMPLE_CHARS = 16_384  # of each of them
DICTIONARY_BYTES = 16_384
DATE = "2024-01-01T00:00:00Z"
READ_BYTES = 1 << 20


class BrokenArchive(ValueError):
    """An archive that does not hold what it states."""


def train_dictionary(pages: DataFrame, id_col: str, html_col: str) -> bytes:
    """A dictionary from a bounded sample: the pages first in order of a hash of their id."""
    start = F.substring(F.col(f"`{html_col}`"), 1, SAMPLE_CHARS)
    texts = [text.encode() for text in first_texts(pages, id_col, F.when(start != "", start), SAMPLE_PAGES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:  # too few or too small samples
        return b""


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def make_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """A response with its payload, or a revisit without."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        fields.insert(2, ("WARC-Target-URI", safe))
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = b"".join(f"{name}: {value}\r\n".encode() for name, value in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record; raises unless version, fields, length and end are as they must be."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION or not gap:
        raise BrokenArchive("a record without version or head")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    missing = {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} - fields.keys()
    if missing:
        raise BrokenArchive(f"a record without {', '.join(sorted(missing))}")
    size = int(fields["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BrokenArchive(f"{fields['WARC-Record-ID']}: {len(rest) - 4} bytes, not the {size} it states")
    return fields, rest[:size]


def facts_of(fields: dict[str, str], block: bytes) -> tuple[str, int, str, str, str | None]:
    """Record id, payload size and digest, type and id referred to; the payload is held against its digest."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise BrokenArchive(f"{fields['WARC-Record-ID']}: the payload is not the one recorded")
    if kind == "revisit" and (payload or "WARC-Refers-To" not in fields):
        raise BrokenArchive(f"{fields['WARC-Record-ID']}: a revisit with a payload or without its response")
    return fields["WARC-Record-ID"], size, digest, kind, fields.get("WARC-Refers-To")


class ArchiveWriter:
    """Writes one archive to a stream."""

    def __init__(self, stream, dictionary: bytes):
        self.stream, self.size, self.records = stream, 0, 0
        given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=given, write_checksum=True)
        self.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self.write(self.compressor.compress(record))
        self.records += 1


def read_frames(stream) -> Iterator[bytes]:
    """The records of an archive, one frame at a time; memory holds one record and a buffer."""
    head = stream.read(8)
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic != DICTIONARY_FRAME:
        raise BrokenArchive("the archive does not begin with its dictionary")
    dictionary = stream.read(size)
    if len(dictionary) != size:
        raise BrokenArchive("the dictionary is cut off")
    given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decompressor = zstandard.ZstdDecompressor(dict_data=given)
    data = stream.read(READ_BYTES)
    while data:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not data:
                raise BrokenArchive("the last record is cut off")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else stream.read(READ_BYTES)
        yield b"".join(parts)
        data = data or stream.read(READ_BYTES)


def revisits(pages: DataFrame, id_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """(id, digest, refers_to) of the pages whose payload another page holds.

    Of equal payloads the largest id is the response. The largest id combines on the map side; a payload that a third
    of all pages share is one row per task.
    """
    data = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    large = pages.select(F.col(f"`{id_col}`").alias("id"), data.alias("html")).filter(F.octet_length("html") >= least_bytes)
    hashed = land(large.select("id", F.sha2("html", 256).alias("digest")), "payloads")
    keepers = hashed.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    keepers = land(keepers.filter("n > 1 AND refers_to IS NOT NULL").drop("n"), "keepers")
    same = F.col("id").eqNullSafe(F.col("refers_to"))
    return land(hashed.join(keepers, "digest").filter(~same).distinct(), "revisits")


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = LEAST_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write all pages; one row per archive: file and number of records.

    Pages stay where they are read, unless the table of revisits is too large for Spark to broadcast. Every attempt of
    a task writes files of its own, and only those of finished tasks are listed.
    """
    dictionary = train_dictionary(pages, id_col, html_col)
    again = revisits(pages, id_col, html_col, least_bytes).withColumnRenamed("id", "again_id")
    data = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), data.alias("html"))
    same = F.col("id").eqNullSafe(F.col("again_id")) & (F.sha2("html", 256) == F.col("digest"))
    rows = rows.join(again, same, "left").select("id", "url", F.col("html").cast("binary").alias("html"), "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = writer = file = None

        def closed() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_pydict({"file": [file], "n_records": [writer.records]})

        for batch in batches:
            for page_id, url, html, refers_to in zip(*batch.columns):
                if writer is None:
                    file = new_name(folder, ".warc.zst")
                    stream = created(file)
                    writer = ArchiveWriter(stream, dictionary)
                payload = html.as_py()
                digest = hashlib.sha1(payload).hexdigest()
                writer.add(make_record(page_id.as_py(), url.as_py(), payload, digest, refers_to.as_py()))
                if writer.size >= archive_bytes:
                    yield closed()
                    writer = None
        if writer is not None:
            yield closed()

    return rows.mapInArrow(run, "file string, n_records bigint")


def read_archives(archives: DataFrame, id_type: str = "bigint", id_col: str = "page_id") -> DataFrame:
    """One row per record of the archives listed in column ``file``, every record validated."""
    count = archives.count()
    rows = archives.select("file").repartition(max(1, count), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                with opened(file) as stream:
                    found = [facts_of(*parse_record(data)) for data in read_frames(stream)]
                ids, sizes, digests, kinds, referred = zip(*found) if found else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                     pa.array(kinds, pa.string()), pa.array(referred, pa.string())],
                    names=["record", "payload_bytes", "payload_digest", "record_type", "refers"],
                )

    schema = "record string, payload_bytes bigint, payload_digest string, record_type string, refers string"
    records = rows.mapInArrow(run, schema)

    def page(column: str):
        return F.nullif(F.regexp_extract(column, r"^<urn:page:(.*)>$", 1), F.lit("")).cast(id_type)

    return records.select(
        page("record").alias(id_col), "payload_bytes", "payload_digest", "record_type", page("refers").alias("refers_to")
    )


def archive_pages(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Write all pages and read the archives back: per page id, payload size, digest, record type, ``refers_to``.

    A null html is an empty payload; a null url leaves the field out. A page without id is never a response that others
    refer to: its copies are, or all are responses. Rows that repeat id and payload are alike. Other columns are not
    read. An empty table gives no rows.
    """
    folder = scratch_path(pages.sparkSession, "archives")
    archives = land(write_archives(pages, folder, id_col, **options), "manifest")
    return read_archives(archives, pages.schema[id_col].dataType.simpleString(), id_col)
