"""Zstandard web archives: one frame per record, the dictionary in a leading skippable frame.

The writer trains a dictionary on the first records of each file and stores it uncompressed. The
reader loads the dictionary (stored or compressed), decodes one frame per record and checks version,
headers, lengths and digests. Files stand in the shared folder; tasks write them under their final
names only when complete, so a repeated task replaces its own file.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.shared import cut, new_folder, open_folder, publish

#: Payloads of fewer bytes are always written in full.
REVISIT_BYTES = 1000
#: Records a file's dictionary is trained on, by number and by bytes.
DICTIONARY_RECORDS = 256
DICTIONARY_SAMPLE_BYTES = 4_000_000
DICTIONARY_BYTES = 16_384
#: A file is closed by the record that reaches this size.
FILE_BYTES = 64_000_000
READ_BYTES = 1 << 18
#: The tables carry no time of capture.
UNKNOWN_DATE = "1970-01-01T00:00:00Z"

VERSION = b"WARC/1.1"
DICTIONARY_FRAME = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_FRAME = 0xFD2FB528
_URL_SAFE = "".join(map(chr, range(0x21, 0x7F)))
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class ArchiveError(ValueError):
    """The archive or one of its records is broken."""


def _lines(first: bytes, fields: list[tuple[str, str]]) -> bytes:
    return first + b"\r\n" + b"".join(
        f"{name}: {value}\r\n".encode() for name, value in fields) + b"\r\n"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, revisit: bool,
           refers_to: int | None, serial: str) -> bytes:
    """A response record with the payload, or a revisit record with its HTTP header alone."""
    http = _lines(b"HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"),
                                       ("Content-Length", str(len(payload)))])
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, serial)}>"),
        ("WARC-Date", UNKNOWN_DATE),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Block-Digest", _sha1(block)),
        ("WARC-Payload-Digest", _sha1(payload)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", urllib.parse.quote(url, safe=_URL_SAFE)))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if revisit:
        fields.append(("WARC-Profile", PROFILE))
        fields.append(("Refers-To-Page-ID", str(refers_to)))
    return _lines(VERSION, fields) + block + b"\r\n\r\n"


class Writer:
    """Writes one archive; holds the records its dictionary is trained on until that is done."""

    def __init__(self, sink):
        self.sink, self.written, self.records = sink, 0, 0
        self.sample: list[bytes] | None = []
        self.sampled = 0
        self.compressor = None

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.written += len(data)

    def _start(self) -> None:
        waiting, self.sample = self.sample, None
        dictionary = None
        try:
            dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, waiting)
        except zstandard.ZstdError:
            pass  # too few or too short samples: an archive may lack a dictionary
        if dictionary is not None:
            data = dictionary.as_bytes()
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(data)) + data)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary,
                                                   write_checksum=True, write_content_size=True)
        for data in waiting:
            self._put(self.compressor.compress(data))

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.sample is None:
            self._put(self.compressor.compress(data))
            return
        self.sample.append(data)
        self.sampled += len(data)
        if len(self.sample) >= DICTIONARY_RECORDS or self.sampled >= DICTIONARY_SAMPLE_BYTES:
            self._start()

    def close(self) -> None:
        if self.sample is not None:
            self._start()
        self.sink.close()


def _frames(source) -> Iterator[bytes]:
    """Contents of the Zstandard frames of an archive, one at a time."""
    held = b""

    def need(size: int) -> bool:
        nonlocal held
        while len(held) < size:
            more = source.read(max(READ_BYTES, size - len(held)))
            if not more:
                return False
            held += more
        return True

    decoder, first = zstandard.ZstdDecompressor(), True
    while need(1):
        if not need(4):
            raise ArchiveError("archive ends inside a frame")
        magic = int.from_bytes(held[:4], "little")
        if magic in _SKIPPABLE:
            size = int.from_bytes(held[4:8], "little") if need(8) else 0
            if not need(8 + size):
                raise ArchiveError("archive ends inside a skippable frame")
            content, held = held[8:8 + size], held[8 + size:]
            if magic == DICTIONARY_FRAME:
                if not first:
                    raise ArchiveError("the dictionary is not the first frame")
                if content[:4] == _FRAME.to_bytes(4, "little"):
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                decoder = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(content))
            first = False
            continue
        if magic != _FRAME:
            raise ArchiveError("neither a frame nor a skippable frame")
        first = False
        frame, parts = decoder.decompressobj(), []
        try:
            while True:
                parts.append(frame.decompress(held))
                if frame.eof:
                    held = frame.unused_data
                    break
                held = source.read(READ_BYTES)
                if not held:
                    raise ArchiveError("archive ends inside a frame")
        except zstandard.ZstdError as error:
            raise ArchiveError(f"broken frame: {error}") from error
        yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise ArchiveError("header line without a colon")
        out[name.strip().lower().decode()] = value.strip().decode()
    return out


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and HTTP body of a frame that must hold exactly one record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version != VERSION:
        raise ArchiveError("not a record of the expected version")
    fields = _fields(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ArchiveError(f"record without {name}")
    if not fields["content-length"].isdecimal():
        raise ArchiveError("content length is no number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ArchiveError("record length differs from its header")
    block = rest[:size]
    if _sha1(block) != fields.get("warc-block-digest"):
        raise ArchiveError("block digest differs")
    http_head, gap, body = block.partition(b"\r\n\r\n")
    status, _, lines = http_head.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ArchiveError("block without an HTTP header")
    http = _fields(lines)
    if fields["warc-type"] == "response":
        if not http.get("content-length") == str(len(body)):
            raise ArchiveError("payload length differs from its HTTP header")
        if _sha1(body) != fields.get("warc-payload-digest"):
            raise ArchiveError("payload digest differs")
    elif fields["warc-type"] != "revisit" or body:
        raise ArchiveError("neither a response nor an empty revisit")
    return fields, http, body


def read_records(source) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """Every record of an archive, checked."""
    for content in _frames(source):
        yield parse_record(content)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def describe(fields: dict[str, str], http: dict[str, str]) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a record."""
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    return (_number(fields.get("page-id")), int(http["content-length"]), digest,
            fields["warc-type"], _number(fields.get("refers-to-page-id")))


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                 least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, original) where original names the equal payload's response, if any.

    Only digests and keys of repeated payloads are gathered; pages meet them once, by digest, where
    a common payload is split by adaptive execution.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"), F.sha1(payload).alias("digest"),
        F.octet_length(payload).alias("bytes"))
    repeated = rows.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(
        F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return rows.join(repeated, ["digest", "bytes"], "left").select(
        "page_id", "url", "html", "original")


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write (page_id, url, html, original) rows as archives; returns (path, records) of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        writer, number, row, made = None, 0, 0, []

        def finish():
            name = f"part-{part:06d}-{number:05d}.warc.zst"
            writer.close()
            publish(fs, f"{base}/{name}.{attempt}.tmp", f"{base}/{name}")
            made.append((f"{folder}/{name}", writer.records))

        for batch in batches:
            for page_id, url, html, original in zip(*(batch.column(i) for i in range(4))):
                page_id, original = page_id.as_py(), original.as_py()
                if writer is None:
                    name = f"{base}/part-{part:06d}-{number:05d}.warc.zst.{attempt}.tmp"
                    writer = Writer(fs.open_output_stream(name, compression=None))
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                revisit = original is not None and original != page_id
                writer.add(record(page_id, url.as_py(), payload, revisit, original,
                                  f"{folder.rsplit('/', 1)[-1]}/{part}/{row}"))
                row += 1
                if writer.written >= file_bytes:
                    finish()
                    writer, number = None, number + 1
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in made], pa.string()),
             pa.array([m[1] for m in made], pa.int64())], names=["path", "records"])

    return cut(records.select("page_id", "url", "html", "original").mapInArrow(
        run, "path string, records bigint"))


def read_archives(files: DataFrame, rows_a_batch: int = 2_000) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, records in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                fs, inside = open_folder(path)
                found, rows = 0, []
                with fs.open_input_stream(inside, compression=None) as source:
                    for fields, http, _ in read_records(source):
                        rows.append(describe(fields, http))
                        found += 1
                        if len(rows) >= rows_a_batch:
                            yield batch_of(rows)
                            rows = []
                if found != records:
                    raise ArchiveError(f"{path} has {found} records instead of {records}")
                if rows:
                    yield batch_of(rows)

    # One file a task; the list is tiny, so its size must not decide the number of tasks.
    tasks = max(1, min(files.count(), 10_000))
    return files.select("path", "records").repartition(tasks).mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string,"
             " refers_to bigint")


def archived_pages(pages: DataFrame, key: str = "page_id", url: str = "url",
                   html: str = "html", **options) -> DataFrame:
    """Write every page as a record below the shared folder and read the archives back.

    Null html is an empty payload; null urls and ids leave their header out. Of equal payloads of
    at least 1000 bytes the rows with the largest id are responses (repeated rows all are), rows
    without an id revisit them; where no row has an id all are responses. An empty table writes no
    file; extra columns are ignored.
    """
    folder = new_folder(pages.sparkSession, "warc")
    files = write_archives(plan_records(pages, key, url, html), folder, **options)
    return read_archives(files).withColumnRenamed("page_id", key)
