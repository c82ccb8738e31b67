import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from wakeline.llm.warc import (DICTIONARY_FRAME, ArchiveError, Writer, archived_pages, parse_record,
                               plan_records, read_archives, read_records, record, write_archives)


class Kept(io.BytesIO):
    def close(self):
        self.data = self.getvalue()


def archive(records):
    sink = Kept()
    writer = Writer(sink)
    for data in records:
        writer.add(data)
    writer.close()
    return sink.data


def some_records(n=400):
    return [record(i, f"http://h.example/{i}", f"<p>page {i} {'lorem ipsum ' * (i % 40)}".encode(),
                   False, None, str(i)) for i in range(n)]


def test_dictionary_leads_and_every_frame_is_one_record():
    records = some_records()
    data = archive(records)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == DICTIONARY_FRAME
    found = list(read_records(io.BytesIO(data)))
    assert [int(f["page-id"]) for f, _, _ in found] == list(range(400))
    assert found[7][2] == b"<p>page 7 " + b"lorem ipsum " * 7
    # A compressed dictionary means the same.
    packed = zstandard.compress(data[8:8 + size])
    other = struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed + data[8 + size:]
    assert list(read_records(io.BytesIO(other))) == found


def test_archive_without_dictionary_and_empty_archive():
    data = archive(some_records(2))
    assert data[:4] != struct.pack("<I", DICTIONARY_FRAME)
    assert len(list(read_records(io.BytesIO(data)))) == 2
    assert list(read_records(io.BytesIO(archive([])))) == []


def test_broken_archives_are_refused():
    data = archive(some_records())
    for broken in (data[:-3], data[:5], b"\x00" * 8 + data, data + b"junk",
                   data[:-9] + bytes([data[-9] ^ 1]) + data[-8:]):
        with pytest.raises(ArchiveError):
            list(read_records(io.BytesIO(broken)))


@pytest.mark.parametrize("change", [
    lambda d: d.replace(b"WARC/1.1", b"WARC/9.9", 1),
    lambda d: d.replace(b"WARC-Date", b"WARC-Dote"),
    lambda d: d + b"x", lambda d: d[:-1],
    lambda d: d.replace(b"payload", b"pAyload"),
    lambda d: d.replace(b"Content-Length: ", b"Content-Length: x", 1),
    lambda d: d.replace(b"WARC-Type: response", b"WARC-Type: resource"),
    lambda d: d.replace(b"WARC-Type: ", b"WARC-Type "),
])
def test_broken_records_are_refused(change):
    data = record(1, "u", b"the payload", False, None, "s")
    assert parse_record(data)[2] == b"the payload"
    with pytest.raises(ArchiveError):
        parse_record(change(data))


def test_pages_round_trip(spark):
    big, other = "<p>" + "é" * 800, "x" * 1000
    rows = [(3, "http://a/ü b\r\nX: y", big), (9, None, big), (None, "u", big), (5, "u", "x" * 999),
            (6, "u", "x" * 999), (7, "u", other), (7, "u", other), (2, "u", other), (8, "u", None),
            (10, "u", ""), (11, "u", "y" * 300_000), (None, "u", "z" * 2000),
            (None, "u", "z" * 2000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns(
        {"digest": F.lit("d"), "original": F.lit(1), "bytes": F.lit(2)})
    want = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [i for i, _, h in rows if h == html and i is not None]
        first = max(same) if len(payload) >= 1000 and same else page_id
        revisit = first != page_id
        want.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(),
                     "revisit" if revisit else "response", first if revisit else None))
    got = archived_pages(pages).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert archived_pages(pages.where("false")).count() == 0


def test_files_roll_over_and_hold_the_pages(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, f"http://h/{i}", f"text {i} " * 200) for i in range(600)],
        "page_id bigint, url string, html string").coalesce(1)
    files = write_archives(plan_records(pages), f"file://{tmp_path}/w", file_bytes=4_000)
    paths = [r.path for r in files.collect()]
    assert len(paths) > 1 and not list((tmp_path / "w").glob("*.tmp"))
    bodies = {}
    for path in paths:
        with open(path.removeprefix("file://"), "rb") as source:
            for fields, _, body in read_records(source):
                bodies[int(fields["page-id"])] = body.decode()
    assert bodies == {i: f"text {i} " * 200 for i in range(600)}
    assert read_archives(files).count() == 600
