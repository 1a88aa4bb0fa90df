"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle ends in a seek table (a skippable
frame, after the public seekable format), and an index maps each record to its bundle, frame and
offset inside the decompressed frame, so one record costs one frame.  Every task writes bundles of
its own under names that no other attempt uses; only names that the index holds are read, so
a task that is lost and runs again leaves at most a file that nothing refers to.

Of records with equal payloads of at least ``least`` bytes, the one with the largest id is a
``response`` and the others are ``revisit`` records that refer to it and hold no payload.

A null payload is empty.  A null id is written as a response and never referred to.  Repeated rows
give a record each; those with one id and payload are of the same type.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.llm.batches import slices
from namewright.llm.storage import keep, shared_dir

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX = "record_id long, bundle string, frame int, offset long, length long"
RECORD = "record_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
URN = "urn:x-page:"


def filesystem(uri: str):
    """A file system that executors can write to, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def record_bytes(record_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; revisits keep length and digest of the payload in their header."""
    body = b"" if refers_to is not None else payload
    name = lambda i: f"<{URN}{'' if i is None else i}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name(record_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: {name(refers_to)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple]:
    """(offset, length, record_id, url, type, refers_to, payload_bytes, digest, payload) of each record."""
    at = 0
    number = lambda s: int(s[len(URN) + 1 : -1]) if len(s) > len(URN) + 2 else None
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        head = dict(x.split(": ", 1) for x in lines[1:])
        begin = end + 4
        stop = begin + int(head["Content-Length"])
        refers = head.get("WARC-Refers-To")
        yield (
            at,
            stop + 4 - at,
            number(head["WARC-Record-ID"]),
            head.get("WARC-Target-URI"),
            head["WARC-Type"],
            number(refers) if refers else None,
            int(head["X-Payload-Length"]),
            head["WARC-Payload-Digest"].removeprefix("sha1:"),
            data[begin:stop],
        )
        at = stop + 4


class BundleWriter:
    """A bundle under construction: independent frames, then the seek table."""

    def __init__(self, folder: str, level: int):
        import zstandard

        self.fs, path = filesystem(folder)
        self.fs.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = self.fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.squeeze = zstandard.ZstdCompressor(level=level)
        self.sizes: list[tuple[int, int]] = []
        self.written = 0

    def frame(self, data: bytes) -> int:
        packed = self.squeeze.compress(data)
        self.out.write(packed)
        self.sizes.append((len(packed), len(data)))
        self.written += len(packed)
        return len(self.sizes) - 1

    def close(self) -> None:
        self.out.write(seek_table(self.sizes))
        self.out.close()


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Compressed and plain size of each frame; the footer holds their number."""
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(source) -> list[tuple[int, int, int]]:
    """(file offset, compressed size, plain size) of each frame, from a bundle's end."""
    size = source.size()
    source.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    source.seek(size - 9 - 8 * n)
    at, out = 0, []
    for packed, plain in struct.iter_unpack("<II", source.read(8 * n)):
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(source, frame: tuple[int, int, int]) -> bytes:
    import zstandard

    at, packed, plain = frame
    source.seek(at)
    return zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=plain)


def read_record(folder: str, bundle: str, frame: int, offset: int, length: int) -> tuple:
    """One record by its place in the index: reads the footer and a single frame."""
    fs, path = filesystem(folder)
    with fs.open_input_file(f"{path}/{bundle}") as source:
        data = read_frame(source, read_seek_table(source)[frame])
    return next(parse_records(data[offset : offset + length]))


def revisits(pages: DataFrame, id_col: str, payload_col: str, least: int) -> DataFrame:
    """(id, digest, refers_to) of the records whose payload another one keeps."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    slim = pages.select(F.col(id_col).cast("long").alias("record_id"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    slim = slim.where(F.col("record_id").isNotNull() & (F.col("n") >= least)).select("record_id", "digest")
    last = slim.groupBy("digest").agg(F.max("record_id").alias("refers_to"), F.min("record_id").alias("first"))
    last = last.where("first < refers_to").drop("first")
    return slim.join(last, "digest").where("record_id <> refers_to").distinct()


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = 1000,
    frame_bytes: int = 1 << 20,
    bundle_bytes: int = 1 << 28,
    level: int = 3,
) -> DataFrame:
    """Write every row as a record below ``folder`` (a shared folder) and return the index, as a kept table."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    full = pages.select(F.col(id_col).cast("long").alias("record_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    full = full.withColumn("digest", F.sha1("payload"))
    rows = full.join(revisits(pages, id_col, payload_col, least), ["record_id", "digest"], "left")
    names = ["record_id", "bundle", "frame", "offset", "length"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, pending, size = None, [], 0
        index: list[tuple] = []

        def flush() -> None:
            nonlocal writer, pending, size
            if not pending:
                return
            writer = writer or BundleWriter(folder, level)
            frame, at = writer.frame(b"".join(x[1] for x in pending)), 0
            for record_id, data in pending:
                index.append((record_id, writer.name, frame, at, len(data)))
                at += len(data)
            pending, size = [], 0
            if writer.written >= bundle_bytes:
                writer.close()
                writer = None

        def made() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array([x[i] for x in index], t) for i, t in enumerate(kinds)], names)
            index.clear()
            return out

        for batch in slices(batches, "payload"):
            for i, url, body, digest, refers in zip(*(batch.column(c).to_pylist() for c in ("record_id", "url", "payload", "digest", "refers_to")), strict=True):
                data = record_bytes(i, url, body, digest, refers)
                pending.append((i, data))
                size += len(data)
                if size >= frame_bytes:
                    flush()
            if index:
                yield made()
        flush()
        if writer:
            writer.close()
        if index:
            yield made()

    return keep(rows.select("record_id", "url", "payload", "digest", "refers_to").mapInArrow(work, INDEX))


def read_archives(index: DataFrame, folder: str, with_payload: bool = True, part_bytes: int = 8 << 20) -> DataFrame:
    """Every record of the index, read at its place: bundle, frame, offset and length.

    Length and digest are of the payload as read (of the header, for revisits).  A bundle is one task's, which opens it once and
    decompresses each frame once; a place that holds another record is an error.
    """
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        source, opened, frames, place, data = None, None, [], None, b""
        rows: list[tuple] = []
        size = 0

        def made() -> pa.RecordBatch:
            nonlocal size
            out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)
            rows.clear()
            size = 0
            return out

        for batch in batches:
            for record_id, bundle, frame, offset, length in zip(*(batch.column(c).to_pylist() for c in ("record_id", "bundle", "frame", "offset", "length")), strict=True):
                if bundle != opened:
                    if source is not None:
                        source.close()
                    source, opened = fs.open_input_file(f"{path}/{bundle}"), bundle
                    frames, place = read_seek_table(source), None
                if frame != place:
                    data, place = read_frame(source, frames[frame]), frame
                _, held, i, url, kind, refers, n, digest, body = next(parse_records(data[offset : offset + length]))
                if held != length or i != record_id:
                    raise ValueError(f"{bundle}: the index and frame {frame} disagree at {offset}")
                if kind == "response":
                    n, digest = len(body), hashlib.sha1(body).hexdigest()
                rows.append((i, url, kind, refers, n, digest, body if with_payload else None))
                size += length if with_payload else 200
                if size >= part_bytes:
                    yield made()
        if source is not None:
            source.close()
        if rows:
            yield made()

    bundles = max(1, index.select("bundle").distinct().count())
    return index.repartition(bundles, "bundle").sortWithinPartitions("bundle", "frame", "offset").mapInArrow(work, RECORD)


def archive_roundtrip(pages: DataFrame, **options) -> DataFrame:
    """Write the archives to a new shared folder and read every record back."""
    folder = shared_dir(pages.sparkSession) + "/warc"
    return read_archives(write_archives(pages, folder, **options), folder, with_payload=False)
