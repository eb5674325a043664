"""WARC archives with one Zstandard frame per record and the dictionary in a leading skippable frame."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.chunks import sliced
from dayledger.llm.files import open_file, write_file
from dayledger.sinks.staging import fresh_path, stage

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME = 0xFD2FB528
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_REVISIT = 1000
ARCHIVE_BYTES = 16 << 20
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 4096, 16 << 10
STEP = 64 << 10


class BadArchive(ValueError):
    """What a reader finds wrong, with the file and the place."""


def roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest and refers_to: the largest page_id among rows of equal
    payload where that is another row and the payload is long enough. Null html is an empty payload.
    A row without an id refers to one that has an id. Repeated rows of the largest id are all
    responses."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumns({"_key": F.sha2("payload", 256), "_bytes": F.octet_length("payload")})
    last = stage(
        rows.where(F.col("_bytes") >= LEAST_REVISIT).groupBy("_key", "_bytes")
        .agg(F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1").drop("_n"), "last-pages",
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last"))
    return rows.join(last, ["_key", "_bytes"], "left").select(
        "page_id", "url", "payload", F.sha1("payload").alias("payload_digest"), refers.alias("refers_to")
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """The record of a page. A revisit has the response's headers and no payload."""
    kind = "response" if refers_to is None else "revisit"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers_to is not None:
        fields += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", REVISIT)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def archive_bytes(records: list[bytes], level: int = 3) -> bytes:
    """An archive of the records. A dictionary is trained on some of them; with too few there is none."""
    dictionary, out = None, []
    try:
        samples = [r[:SAMPLE_BYTES] for r in records[:: max(1, len(records) // SAMPLES)]]
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
        data = dictionary.as_bytes()
        out.append(struct.pack("<II", DICTIONARY_FRAME, len(data)) + data)
    except zstandard.ZstdError:
        pass
    packer = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True, write_content_size=True)
    return b"".join(out + [packer.compress(r) for r in records])


def read_archive(file, path: str = "") -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of each record: one frame each, the dictionary of the leading skippable frame
    applied. Holds one record at a time."""
    head, dictionary, at = file.read(8), None, 0
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", head[4:])[0]
        data = file.read(size)
        if len(data) != size:
            raise BadArchive(f"{path}: the dictionary is cut off")
        if struct.unpack("<I", data[:4])[0] == FRAME:  # it may be compressed itself
            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        dictionary, at = zstandard.ZstdCompressionDict(data), 8 + size
    file.seek(at)
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    held = b""
    while True:
        held = held or file.read(STEP)
        if not held:
            return
        if len(held) < 4:
            held += file.read(STEP)
        magic = struct.unpack("<I", held[:4])[0] if len(held) >= 4 else 0
        if magic in SKIPPABLE:
            while len(held) < 8 and (more := file.read(STEP)):
                held += more
            end = 8 + struct.unpack("<I", held[4:8])[0] if len(held) >= 8 else 8
            while len(held) < end and (more := file.read(STEP)):
                held += more
            if len(held) < end:
                raise BadArchive(f"{path}: a skippable frame at {at} is cut off")
            held, at = held[end:], at + end
            continue
        frame, parts, size = unpacker.decompressobj(), [], 0
        try:
            while not frame.eof:
                if not held and not (held := file.read(STEP)):
                    raise BadArchive(f"{path}: the frame at {at} is cut off")
                parts.append(frame.decompress(held))
                size += len(held) - len(frame.unused_data)
                held = frame.unused_data
        except zstandard.ZstdError as error:
            raise BadArchive(f"{path}: the frame at {at} is damaged: {error}") from None
        yield at, b"".join(parts)
        at += size


def parse(data: bytes) -> dict:
    """page_id, url, payload_bytes, payload_digest, record_type and refers_to of a record, and its
    payload; raises ValueError where headers, lengths or digest do not hold."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC header")
    fields = _fields(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    size = _length(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"content-length {size}, but {len(rest)} bytes follow the header")
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    answer = http.decode().split("\r\n")
    if not gap or not answer[0].startswith("HTTP/1."):
        raise ValueError("no HTTP header")
    stated = _length(_fields(answer[1:]).get("content-length", ""))
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if not re.fullmatch(r"[0-9a-f]{40}", digest):
        raise ValueError("no SHA-1 payload digest")
    kind, refers = fields["warc-type"], fields.get("warc-refers-to")
    if kind == "response":
        if len(payload) != stated or hashlib.sha1(payload).hexdigest() != digest or refers is not None:
            raise ValueError("the payload is not the one the headers state")
    elif kind != "revisit" or payload or refers is None:
        raise ValueError(f"not a response or a revisit: {kind}")
    return {
        "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": stated,
        "payload_digest": digest, "record_type": kind, "refers_to": None if refers is None else _page(refers), "payload": payload,
    }


def _fields(lines: list[str]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in out:
            raise ValueError(f"bad header line {line!r}")
        out[name.lower()] = value.strip()
    return out


def _length(text: str) -> int:
    if not re.fullmatch(r"[0-9]+", text):
        raise ValueError(f"bad length {text!r}")
    return int(text)


def _page(name: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?[0-9]*)>", name)
    if not found:
        raise ValueError(f"bad record id {name!r}")
    return int(found[1]) if found[1] else None


def write_archives(rows: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write what `roles` gives as archives of about ARCHIVE_BYTES. Gives path and records of each;
    write the rows down before using them."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            name = f"{path}/{part:06d}-{count:06d}.warc.zst"
            write_file(name, archive_bytes(held))
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)], pa.int64())], ["path", "records"])

        for batch in sliced(batches, "payload", ARCHIVE_BYTES):
            for row in batch.to_pylist():
                held.append(record(row["page_id"], row["url"], row["payload"], row["payload_digest"], row["refers_to"], date))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    count, held, size = count + 1, [], 0
        if held:
            yield close()

    return rows.mapInArrow(write, "path string, records long")


FOUND = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, path string, offset long"


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of the archives in `path`, each checked; a bad one ends the job with its place."""
    schema = FOUND + (", payload binary" if with_payload else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_file(path) as file:
                    found: list[dict] = []
                    for offset, data in read_archive(file, path):
                        try:
                            found.append(parse(data) | {"path": path, "offset": offset})
                        except ValueError as error:
                            raise BadArchive(f"{path}: record at {offset}: {error}") from None
                        if len(found) == 500:
                            yield _batch(found, names)
                            found = []
                    if found:
                        yield _batch(found, names)

    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(parts, "path").mapInArrow(read, schema)


KINDS = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "offset": pa.int64(), "payload": pa.binary()}


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], KINDS.get(n, pa.string())) for n in names], names)


def archived(pages: DataFrame) -> DataFrame:
    """Write archives of `pages` (page_id, url, html) to a fresh shared folder and read them back. The
    files stay. Other columns are not read; no pages give no archives."""
    folder = fresh_path(pages.sparkSession, "warc")
    return read_archives(stage(write_archives(roles(pages), folder), "archive-list"))
