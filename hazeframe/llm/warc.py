"""Zstandard WARC archives: writer and reader (operator 4).

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary,
followed by one frame per record, compressed with it. The dictionary is trained by the
writing task on the first records of its archive. Readers get it from the archive alone.
Of records with equal payloads the one with the largest page id is the response; the
others are revisits, which carry the HTTP header but no payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.common import in_tasks, stored
from hazeframe.llm.files import NewFile, open_input, reading_tasks
from hazeframe.session import scratch_path

SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
#: An archive is closed and a new one begun beyond this many bytes.
ARCHIVE_BYTES = 256 << 20
#: Dictionary size, and the first records (number, bytes each) it is trained on.
DICTIONARY_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 16 << 10, 64, 16 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record. A null id is written as ``none``; a null url has no target header;
    white space and control characters of a url are percent-encoded."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = "none" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {date}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and block of one record; raises if a header, length or digest is wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not found or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ValueError(f"not a WARC record: {data[:40]!r}")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.strip() != name or not name:
            raise ValueError(f"malformed WARC header {line!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"WARC header {name} is missing")
    if not re.fullmatch(r"\d+", headers["content-length"]):
        raise ValueError(f"Content-Length {headers['content-length']!r}")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record block of {length} bytes: {len(rest)} bytes follow the header")
    block = rest[:length]
    if "warc-block-digest" in headers and headers["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError("block digest differs")
    return {"headers": headers, "block": block}


def http_payload(record: dict) -> tuple[bytes, int]:
    """(payload held by the record, length its HTTP header gives); checked for responses."""
    http, found, payload = record["block"].partition(b"\r\n\r\n")
    given = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http.replace(b"\r\n", b"\n"))
    if not found or not given:
        raise ValueError("the block is no HTTP message with a length")
    length = int(given[1])
    if record["headers"]["warc-type"] == "response":
        if len(payload) != length:
            raise ValueError(f"HTTP length {length}, payload of {len(payload)} bytes")
        if record["headers"].get("warc-payload-digest") != f"sha1:{digest(payload)}":
            raise ValueError("payload digest differs")
    return payload, length


def train(samples: list[bytes]):
    """A dictionary from sample records; their plain bytes where there are too few to train."""
    import zstandard as zstd

    short = [s[:SAMPLE_BYTES] for s in samples]
    if len(short) >= 8:
        try:
            return zstd.train_dictionary(DICTIONARY_BYTES, short)
        except zstd.ZstdError:
            pass
    return zstd.ZstdCompressionDict(b"".join(short)[:DICTIONARY_BYTES], dict_type=zstd.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    def __init__(self, folder: str, name: str, samples: list[bytes]):
        import zstandard as zstd

        self.file = NewFile(folder, name)
        words = train(samples)
        held = words.as_bytes()
        self.file.write(struct.pack("<II", SKIPPABLE, len(held)) + held)
        self.compressor = zstd.ZstdCompressor(level=3, dict_data=words)
        self.records = 0

    def add(self, record: bytes) -> None:
        self.file.write(self.compressor.compress(record))
        self.records += 1


def read_records(source: BinaryIO, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of each record of one archive, a frame at a time."""
    import zstandard as zstd

    lead = source.read(8)
    if len(lead) < 8:
        raise ValueError("the archive has no leading frame")
    magic, size = struct.unpack("<II", lead)
    if magic != SKIPPABLE:
        raise ValueError("the archive does not start with a dictionary frame")
    held = source.read(size)
    if len(held) != size:
        raise ValueError("the dictionary frame is cut short")
    if held[:4] == ZSTD_MAGIC:
        held = zstd.ZstdDecompressor().decompress(held)
    reader = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(held)) if held else zstd.ZstdDecompressor()
    left = b""
    while left or (left := source.read(chunk)):
        frame, out = reader.decompressobj(), []
        while True:
            out.append(frame.decompress(left))
            if frame.eof:
                left = frame.unused_data
                break
            if not (left := source.read(chunk)):
                raise ValueError("the last frame is cut short")
        yield b"".join(out)


def mark_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (html, null: empty) and refers_to, the largest page id with
    an equal payload where that is another one.

    Equal payloads are found on narrow rows (page id and digest) and counted before the
    shuffle; the payloads themselves only move by the pair (page id, digest), which a
    group of copies does not share. A null id is below all others.
    """
    html = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    keyed = html.withColumn("_key", F.unhex(F.sha1(F.col("payload").cast("binary"))))
    narrow = keyed.select("page_id", "_key")
    largest = narrow.groupBy("_key").agg(F.max("page_id").alias("_to"), F.count("*").alias("_n")).where("_n > 1")
    other = (narrow.distinct().join(largest.select("_key", "_to"), "_key")
             .where("page_id is null and _to is not null or page_id < _to")
             .select(F.col("page_id").alias("_page"), F.col("_key").alias("_k"), F.col("_to").alias("refers_to")))
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("_key") == F.col("_k"))
    return keyed.join(other, same, "left").select("page_id", "url", "payload", "refers_to")


def write_archives(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page; returns the stored manifest (path, records, size).

    Rows that repeat with the largest id of their payload are all responses. No rows
    give no archives.
    """
    folder = scratch_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        out: ArchiveWriter | None = None
        done: list[ArchiveWriter] = []

        def flush():
            nonlocal out
            if held and out is None:
                out = ArchiveWriter(folder, f"{len(done):03d}.warc.zst", held[:SAMPLE_RECORDS])
            for record in held:
                out.add(record)
            held.clear()
            if out and out.file.size >= archive_bytes:
                out.file.close()
                done.append(out)
                out = None

        for batch in batches:
            for page, url, payload, refers in zip(*[c for c in map(lambda c: c.to_pylist(), batch.columns)]):
                held.append(record_bytes(page, url, payload.encode("utf-8", "surrogatepass"), refers, date))
                if len(held) >= SAMPLE_RECORDS:
                    flush()
        flush()
        if out:
            out.file.close()
            done.append(out)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.file.uri for w in done], pa.string()), pa.array([w.records for w in done], pa.int64()),
             pa.array([w.file.size for w in done], pa.int64())], names=["path", "records", "size"])

    return stored(in_tasks(mark_revisits(pages), run, "path string, records long, size long"), "manifest")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record: path, page_id, target_uri, record_type, refers_to,
    payload_digest (bare), payload_bytes (of the full payload) and payload (null for
    revisits, or without ``with_payload``). A record that fails a check is an error."""
    def number(urn: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
        return int(found[1]) if found else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows):
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
            names = ["path", "page_id", "target_uri", "record_type", "refers_to", "payload_digest",
                     "payload_bytes", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, seen, held = [], 0, 0
                with open_input(path) as source:
                    for data in read_records(source):
                        record = parse_record(data)
                        payload, length = http_payload(record)
                        head = record["headers"]
                        rows.append((path, number(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"],
                                     number(head.get("warc-refers-to")), head["warc-payload-digest"].removeprefix("sha1:"),
                                     length, payload if with_payload and head["warc-type"] == "response" else None))
                        seen += 1
                        held += len(payload) if with_payload else 0
                        if len(rows) >= 2000 or held > 16 << 20:
                            yield made(rows)
                            rows, held = [], 0
                if seen != records:
                    raise ValueError(f"{path} holds {seen} records, not {records}")
                yield made(rows)

    spread = manifest.select("path", "records").repartition(reading_tasks(manifest.sparkSession), F.xxhash64("path"))
    return in_tasks(spread, run, "path string, page_id long, target_uri string, record_type string, refers_to long, "
                    "payload_digest string, payload_bytes long, payload binary")
