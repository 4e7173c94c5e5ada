"""WARC archives compressed with Zstandard, one frame per record.

An archive begins with a skippable frame that holds its dictionary, trained on
its first payloads. Every record is a frame of its own, with its content size in
the frame's header, so that a reader can start at any record. A page becomes a
``response`` record with the page as an HTTP answer; a page whose payload another
record holds becomes a ``revisit`` record that names it and keeps the HTTP header
alone.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.llm.textbytes import steps
from burstline.sources.layout import work_path

#: Skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
#: Payload bytes of an archive before the next is begun.
ARCHIVE_BYTES = 8 << 20
#: Payloads of this size or more are stored once.
LEAST_REVISIT = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORD_ID = re.compile(r"<urn:page:(-?\d+)>")


class ArchiveError(ValueError):
    """An archive that breaks its format."""


def record(page_id, url, payload: bytes, digest: str, refers_to=None, revisit=False) -> bytes:
    """One record: header, blank line, block, two line ends."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    name = f"<urn:page:{page_id}>" if page_id is not None else "<urn:page:none>"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", name),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(1, ("WARC-Target-URI", re.sub(r"[\r\n]", "%0A", url)))
    if revisit:
        fields.insert(1, ("WARC-Profile", REVISIT_PROFILE))
        fields.insert(1, ("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def archive(records: list[bytes], dictionary_bytes: int = 16384, level: int = 3) -> bytes:
    """Compress records into one archive; few or tiny records get an empty dictionary."""
    samples = [r[:8192] for r in records[:256]]
    trained = b""
    if len(samples) >= 16 and sum(map(len, samples)) >= 8 * dictionary_bytes:
        trained = zstandard.train_dictionary(
            dictionary_bytes, samples, k=512, d=8, level=level
        ).as_bytes()
    dictionary = zstandard.ZstdCompressionDict(trained) if trained else None
    packer = zstandard.ZstdCompressor(
        level=level, dict_data=dictionary, write_content_size=True, write_checksum=True
    )
    lead = struct.pack("<II", DICTIONARY_MAGIC, len(trained)) + trained
    return lead + b"".join(map(packer.compress, records))


def _headers(lines: bytes, where: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ArchiveError(f"{where}: not a header line: {line[:80]!r}")
        out[name.decode("ascii", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return out


def _length(headers: dict[str, str], where: str) -> int:
    text = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]+", text):
        raise ArchiveError(f"{where}: Content-Length is {text!r}")
    return int(text)


def parse_record(raw: bytes, where: str = "record") -> dict:
    """Check one whole record and return its fields, block and payload."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not blank or not re.fullmatch(rb"WARC/1\.[01]", version):
        raise ArchiveError(f"{where}: no WARC header")
    headers = _headers(lines, where)
    for needed in ("warc-type", "warc-record-id", "warc-date"):
        if not headers.get(needed):
            raise ArchiveError(f"{where}: {needed} is missing")
    length = _length(headers, where)
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ArchiveError(f"{where}: block of {len(rest) - 4} bytes, {length} announced")
    block = rest[:length]
    digest = headers.get("warc-block-digest", "")
    if digest and digest != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise ArchiveError(f"{where}: the block's digest differs")
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not blank or not http.startswith(b"HTTP/"):
        raise ArchiveError(f"{where}: no HTTP header")
    size = _length(_headers(http.partition(b"\r\n")[2], where), where)
    kind = headers["warc-type"]
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != size:
            raise ArchiveError(f"{where}: payload of {len(payload)} bytes, {size} announced")
        if stated != hashlib.sha1(payload).hexdigest():
            raise ArchiveError(f"{where}: the payload's digest differs")
    elif kind == "revisit":
        if payload or not headers.get("warc-refers-to"):
            raise ArchiveError(f"{where}: a revisit record with payload or without reference")
    else:
        raise ArchiveError(f"{where}: unknown type {kind!r}")
    return {
        "headers": headers, "record_type": kind, "payload_bytes": size,
        "payload_digest": stated, "payload": payload if kind == "response" else None,
    }


def read_archive(content: bytes, where: str = "archive") -> Iterator[dict]:
    """The records of an archive, one after the other.

    The dictionary is in the leading skippable frame, itself plain or a
    Zstandard frame. Other skippable frames are passed over. A frame that is cut
    short, or holds anything but one whole record, raises ``ArchiveError``; an
    empty archive has no records.
    """
    view, at, dictionary = memoryview(content), 0, None
    while at < len(view):
        if len(view) - at < 8:
            raise ArchiveError(f"{where}: {len(view) - at} bytes at the end")
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if at + 8 + size > len(view):
                raise ArchiveError(f"{where}: a skippable frame is cut short")
            if not at and magic == DICTIONARY_MAGIC and size:
                raw = bytes(view[at + 8 : at + 8 + size])
                if raw.startswith(FRAME_MAGIC):
                    raw = zstandard.ZstdDecompressor().decompress(raw)
                dictionary = zstandard.ZstdCompressionDict(raw)
            at += 8 + size
            continue
        unpacker = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        name = f"{where} at byte {at}"
        try:
            stated = zstandard.get_frame_parameters(bytes(view[at : at + 18])).content_size
            raw = unpacker.decompress(view[at:])
        except zstandard.ZstdError as error:
            raise ArchiveError(f"{name}: {error}") from error
        if not unpacker.eof:
            raise ArchiveError(f"{name}: the frame is cut short")
        if stated not in (zstandard.CONTENTSIZE_UNKNOWN, len(raw)):
            raise ArchiveError(f"{name}: {len(raw)} bytes, {stated} announced")
        at = len(view) - len(unpacker.unused_data)
        yield parse_record(raw, name)


def first_responses(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Of each payload of ``least`` bytes or more that several pages have, the largest id.

    Returns ``sha, response_id``; ``sha`` joins SHA-1 and SHA-256 of the payload.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    large = pages.filter(F.octet_length("html") >= least).select("page_id", _key(payload))
    return (
        large.groupBy("sha")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .filter("n > 1").drop("n")
    )


def _key(payload) -> F.Column:
    return F.concat(F.sha1(payload), F.sha2(payload, 256)).alias("sha")


def write_archives(
    pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, least: int = LEAST_REVISIT
) -> DataFrame:
    """Archives of all rows of ``pages`` (``page_id, url, html``): ``content``.

    Each task cuts its records into archives of about ``archive_bytes``; a null
    page is an empty payload, a null id or url is left out of the header. Of
    equal payloads of ``least`` bytes or more the record with the largest id is
    a response; the others, repeated rows with that id included but for one of
    them, revisit it. Store the result with ``write_files`` or as a table.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", _key(payload))
    firsts = first_responses(pages, least).withColumnRenamed("sha", "first_sha")
    marked = rows.join(firsts, rows["sha"] == firsts["first_sha"], "left").select(
        "page_id", "url", "html", F.substring("sha", 1, 40).alias("digest"), "response_id"
    )

    def pack(batches: Iterator[pa.RecordBatch]):
        records, size = [], 0
        for batch in steps(batches, "html", archive_bytes):
            for row in batch.to_pylist():
                body, first = (row["html"] or "").encode(), row["response_id"]
                again = first is not None and row["page_id"] != first
                records.append(
                    record(row["page_id"], row["url"], body, row["digest"], first, again)
                )
                size += len(records[-1])
                if size >= archive_bytes:
                    yield _one(archive(records))
                    records, size = [], 0
        if records:
            yield _one(archive(records))

    return marked.mapInArrow(pack, "content binary")


def _one(content: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])


def read_records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of archives in a binary column ``content``.

    ``spark.read.format("binaryFile").load(path)`` gives such a table of archive
    files. Returns ``record_id, page_id, url, record_type, payload_bytes,
    payload_digest, refers_to`` and, unless ``payloads`` is false, ``payload``,
    null for revisits. A null or empty archive has no records; a broken one
    fails the job.
    """
    columns = [
        ("record_id", "string"), ("page_id", "long"), ("url", "string"),
        ("record_type", "string"), ("payload_bytes", "long"), ("payload_digest", "string"),
        ("refers_to", "long"),
    ] + [("payload", "binary")] * payloads
    names = [name for name, _ in columns]

    def unpack(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for found in read_archive(content.as_py() or b""):
                    rows.append(_row(found, names))
                    size += len(found["payload"] or b"") * payloads
                    if size > ARCHIVE_BYTES:
                        yield _table(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _table(rows, names)

    return archives.select("content").mapInArrow(unpack, ", ".join(f"{n} {t}" for n, t in columns))


def _row(found: dict, names: list[str]) -> dict:
    headers = found["headers"]
    own = RECORD_ID.fullmatch(headers["warc-record-id"])
    other = RECORD_ID.fullmatch(headers.get("warc-refers-to", ""))
    row = found | {
        "record_id": headers["warc-record-id"], "page_id": int(own[1]) if own else None,
        "url": headers.get("warc-target-uri"), "refers_to": int(other[1]) if other else None,
    }
    return {name: row[name] for name in names}


def _table(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(),
             "payload": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names
    )


def write_files(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive as a file ``NAME.warc.zst`` in a folder that all executors reach.

    The name is the content's hash, and a file appears under it only when whole,
    so that a task may run again. ``folder`` is a path or URI of a file system
    that Arrow knows. Returns the table of the files' names.
    """

    def write(frames: Iterator[pd.DataFrame]):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        for frame in frames:
            names = []
            for content in frame["content"]:
                name = f"{path}/{hashlib.sha256(content).hexdigest()[:32]}.warc.zst"
                part = f"{name}.{id(content)}.part"
                with system.open_output_stream(part) as out:
                    out.write(content)
                system.move(part, name)
                names.append(name)
            yield pd.DataFrame({"path": names})

    return archives.mapInPandas(write, "path string")


def store(archives: DataFrame, name: str = "archives") -> DataFrame:
    """Write archives as a table in the shared folder, and read it."""
    spark: SparkSession = archives.sparkSession
    path = work_path(spark, name)
    archives.write.option("compression", "none").parquet(path)
    return spark.read.parquet(path)
