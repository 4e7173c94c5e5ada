"""WARC round trips, references, and broken archives."""

import hashlib
import struct
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from burstline.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, content int"


def rows():
    big, small = "<p>é</p>" * 200, "<p>small</p>"
    out = [(i, f"http://x/{i}", big) for i in (3, 9, 4)] + [(i, None, small) for i in (1, 2)]
    out += [(20 + i, f"http://y/{i}\r\nX: y", f"<html>{i}</html>" * (i + 1)) for i in range(60)]
    return out + [(100, "u", None), (101, "u", ""), (None, "u", "no id"), (102, "u", "z" * 300_000)]


def frame(spark, some):
    return spark.createDataFrame([(*r, "clash", 1) for r in some], SCHEMA).repartition(3)


def test_round_trip(spark):
    archives = warc.store(warc.write_archives(frame(spark, rows()), archive_bytes=20_000))
    assert archives.count() > 3
    got = warc.read_records(archives).collect()
    expected = Counter()
    for page, _, html in rows():
        body = (html or "").encode()
        revisit = page in (3, 4)
        expected[page, len(body), hashlib.sha1(body).hexdigest(), 9 if revisit else None,
                 "revisit" if revisit else "response", None if revisit else body] += 1
    assert Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.refers_to, r.record_type,
         None if r.payload is None else bytes(r.payload)) for r in got
    ) == expected
    urls = {r.page_id: r.url for r in got}
    assert urls[1] is None and urls[20] == "http://y/0%0A%0AX: y"


def test_files_round_trip(spark, tmp_path):
    archives = warc.write_archives(frame(spark, rows()), archive_bytes=20_000)
    names = warc.write_files(archives, f"file://{tmp_path}/out").collect()
    files = spark.read.format("binaryFile").load(f"{tmp_path}/out/*.warc.zst")
    assert files.count() == len(names) > 3
    assert warc.read_records(files, payloads=False).count() == len(rows())


def test_empty_table(spark):
    archives = warc.write_archives(frame(spark, rows()).limit(0))
    assert warc.read_records(archives).collect() == []
    nothing = spark.createDataFrame([(None,), (bytearray(),)], "content binary")
    assert warc.read_records(nothing).collect() == []


def record(i, body=b"x" * 500):
    return warc.record(i, "u", body, hashlib.sha1(body).hexdigest())


def test_dictionary_is_in_the_leading_frame():
    records = [record(i, f"<html>{i} common words here</html>".encode() * 60) for i in range(200)]
    packed = warc.archive(records)
    magic, size = struct.unpack_from("<II", packed)
    assert magic == warc.DICTIONARY_MAGIC and size > 0
    assert [r["payload_bytes"] for r in warc.read_archive(packed)]
    with pytest.raises(warc.ArchiveError):
        list(warc.read_archive(packed[8 + size :]))  # without its dictionary
    raw = packed[8 : 8 + size]
    small = zstandard.ZstdCompressor().compress(raw)
    again = struct.pack("<II", warc.DICTIONARY_MAGIC, len(small)) + small + packed[8 + size :]
    assert len(list(warc.read_archive(again))) == 200


def test_one_frame_per_record():
    packed = warc.archive([record(1), record(2)])
    skip = struct.pack("<II", 0x184D2A51, 3) + b"abc"
    assert [r["headers"]["warc-record-id"] for r in warc.read_archive(packed + skip)] == [
        "<urn:page:1>", "<urn:page:2>"
    ]
    two = warc.archive([record(1) + record(2)])
    with pytest.raises(warc.ArchiveError):
        list(warc.read_archive(two))


@pytest.mark.parametrize("cut", [1, 3, 20])
def test_cut_archives(cut):
    packed = warc.archive([record(1), record(2)])
    with pytest.raises(warc.ArchiveError):
        list(warc.read_archive(packed[:-cut]))


@pytest.mark.parametrize(
    ("old", "new"),
    [
        (b"Content-Length: 5", b"Content-Length: 6"), (b"WARC/1.1", b"WARC/9"),
        (b"WARC-Type: response", b"WARC-Type: other"), (b"WARC-Date: 2024-01-01T00:00:00Z\r\n", b""),
        (b"WARC-Record-ID", b"WARC-Other"), (b"xxxx", b"xxxy"), (b"\r\n\r\n", b"\n\n"),
        (b"Content-Length: ", b"Content-Length: -"), (b"sha1:", b"sha1:0"),
    ],
)
def test_broken_records(old, new):
    raw = record(1)
    assert warc.parse_record(raw)["payload_bytes"] == 500
    assert old in raw
    with pytest.raises(warc.ArchiveError):
        warc.parse_record(raw.replace(old, new))


def test_a_broken_archive_fails_the_job(spark):
    bad = spark.createDataFrame([(bytearray(warc.archive([record(1)])[:-1]),)], "content binary")
    with pytest.raises(Exception, match="cut short"):
        warc.read_records(bad).select(F.count("*")).collect()
