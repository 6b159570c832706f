"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent frames of about FRAME_BYTES; a bundle ends in a skippable frame with the
sizes of all frames (the public seekable format), and the index maps each record to its bundle, frame and offset
in the frame, so that a record is read by decompressing one frame. A bundle starts with a warcinfo record. Records
with equal payloads (equal SHA-1) are stored once: the one with the largest id is a response, the others are revisit
records with the HTTP head alone. Record ids are made of the page id and the payload's digest (and a number where a
row repeats), so a revisit names its response's. A URL that WARC-Target-URI can't hold as it is (null, spaces, control
or non-ASCII characters) is escaped there and kept whole in an extension field.

Which record is which is settled on ids and digests alone, a row each; payloads meet these by id and digest, so a
payload that fills a third of the table spreads over all tasks. Rows that repeat, id and payload, are numbered where
they meet. Bundles are written by tasks to the shared folder
and renamed into place; a retried task writes the same bundle. All records are read back by their places in the
index, frame after frame. Null payloads count as empty. A null id is smaller than all others; records equal in id and
payload are all of the same kind. An empty table gives no bundle and an empty result. Only the id, URL and payload
are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import urllib.parse
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hot import hot_lookup
from .common import file_size, fresh_path, read_file, staged, write_file

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 27  # of uncompressed records
REPEATS = 1000  # rows equal in id and payload that one task numbers
#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1


class BundleWriter:
    """Gathers records into frames; add() returns (frame, offset in frame, bytes)."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.frame_bytes, self.pack = frame_bytes, zstandard.ZstdCompressor(level=3)
        self.frames: list[bytes] = []
        self.sizes: list[int] = []
        self.open, self.total = bytearray(), 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        if self.open and len(self.open) + len(record) > self.frame_bytes:
            self._close()
        place = len(self.frames), len(self.open), len(record)
        self.open += record
        self.total += len(record)
        return place

    def _close(self) -> None:
        self.frames.append(self.pack.compress(bytes(self.open)))
        self.sizes.append(len(self.open))
        self.open = bytearray()

    def finish(self) -> bytes:
        if self.open:
            self._close()
        table = b"".join(struct.pack("<II", len(f), n) for f, n in zip(self.frames, self.sizes)) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        return b"".join((*self.frames, struct.pack("<II", SKIPPABLE, len(table)), table))


class Bundle:
    """Frames of a bundle by number, each read from the file when asked for."""

    def __init__(self, file: str):
        size = file_size(file)
        n, _, magic = struct.unpack("<IBI", read_file(file, size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        table = read_file(file, size - 9 - 8 * n, 8 * n)
        self.file, self.at, self.sizes = file, [0], []
        for k in range(n):
            packed, whole = struct.unpack_from("<II", table, 8 * k)
            self.at.append(self.at[-1] + packed)
            self.sizes.append(whole)

    def __len__(self) -> int:
        return len(self.sizes)

    def frame(self, k: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(read_file(self.file, self.at[k], self.at[k + 1] - self.at[k]), max_output_size=self.sizes[k])


def read_record(file: str, frame: int, offset: int, size: int) -> tuple[dict[str, str], bytes]:
    """One record by its place in the index."""
    return next(parse(Bundle(file).frame(frame)[offset : offset + size]))


def record(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in {**headers, "Content-Length": len(block)}.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8") + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records in a row of bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        at = end + 4 + int(headers["Content-Length"])
        yield headers, data[end + 4 : at]
        at += 4


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:pages")


def record_id(page_id: int | None, digest: str, repeat: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id} {digest} {repeat}')}>"


def page_record(page_id: int | None, url: str | None, body: bytes, refers_to: int | None, repeat: int, date: str) -> bytes:
    """A response record, or a revisit record if refers_to names another page."""
    digest = base32_sha1(body)
    target = urllib.parse.quote(url or f"urn:page:{page_id}", safe="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest, repeat),
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http;msgtype=response",
    }
    if page_id is not None:
        headers["X-Page-ID"] = str(page_id)
    if target != url:
        headers["X-Target-URI-JSON"] = json.dumps(url)  # any string on one line
    if refers_to is not None:
        headers |= {"WARC-Refers-To": record_id(refers_to, digest), "X-Refers-To-Page-ID": str(refers_to), "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode("ascii")
    return record(headers, head + (b"" if refers_to is not None else body))


def info_record(file: str, date: str) -> bytes:
    name = file.rsplit("/", 1)[-1]
    block = b"software: contiglink\r\nformat: WARC File Format 1.1\r\n"
    return record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(NAMES, file)}>", "WARC-Date": date, "WARC-Filename": name, "Content-Type": "application/warc-fields"}, block)


def kinds(pages: DataFrame, least: int, id_col: str, payload_col: str, share: int = REPEATS) -> DataFrame:
    """page_id, url, payload, refers_to (null for responses) and share: rows equal in id, payload and share are in one task, next to each other.

    Only where some rows repeat are the payloads dealt out once more for that; a row that repeats very often is
    dealt in shares of about REPEATS rows.
    """
    named = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"), F.monotonically_increasing_id().alias("row")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    keys = staged(named.groupBy("page_id", "digest").agg(F.count("*").alias("copies"), F.max(F.octet_length("payload")).alias("size")), "warc-keys")
    shared = keys.where(F.col("size") >= least).groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    revisits = hot_lookup(keys.where(F.col("size") >= least), shared, ["digest"], "n").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    r = revisits.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to")
    both = named.join(r, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left").drop("r_id", "r_digest")
    repeated = keys.where("copies > 1").select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), F.ceil(F.col("copies") / share).alias("shares"))
    if repeated.isEmpty():
        both = both.withColumn("share", F.lit(0).cast("long"))
    else:
        both = both.join(repeated, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left").drop("r_id", "r_digest")
        both = both.withColumn("share", F.pmod("row", F.coalesce("shares", F.lit(1)))).repartition("page_id", "digest", "share")
    return both.sortWithinPartitions("page_id", "digest", "share").select("page_id", "url", "payload", "refers_to", "share")


def write_archives(pages: DataFrame, folder: str, least: int = 0, id_col: str = "page_id", payload_col: str = "html", bundle_bytes: int = BUNDLE_BYTES, date: datetime | None = None) -> DataFrame:
    """Write bundles to folder and return the index: page_id, file, frame, offset, size. date: of capture; now, if not given."""
    schema = pa.schema([("page_id", pa.int64()), ("file", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("size", pa.int64())])
    stamp = (date or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece = TaskContext.get().partitionId(), 0
        bundle: BundleWriter | None = None
        rows: list[tuple] = []
        last: tuple | None = None
        repeat = 0

        def name() -> str:
            return f"{folder}/part-{part:06d}-{piece:05d}.warc.zst"

        def flush() -> pa.RecordBatch:
            nonlocal bundle, rows, piece
            write_file(name(), bundle.finish())
            ids, places = [r[0] for r in rows], [r[1] for r in rows]
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, [name()] * len(rows), *map(list, zip(*places))), schema)], schema=schema)
            bundle, rows, piece = None, [], piece + 1
            return out

        for batch in batches:
            for page_id, url, payload, refers_to, share in zip(*(batch.column(k) for k in range(5))):
                page_id, url, refers_to, body = page_id.as_py(), url.as_py(), refers_to.as_py(), payload.as_py().encode("utf-8")
                if not bundle:
                    bundle = BundleWriter()
                    bundle.add(info_record(name(), stamp))
                same = page_id, share.as_py(), hashlib.sha1(body).digest()  # rows that repeat follow each other
                repeat, last = (repeat + 1 if same == last else same[1] << 32), same
                rows.append((page_id, bundle.add(page_record(page_id, url, body, refers_to, repeat, stamp))))
                if bundle.total >= bundle_bytes:
                    yield flush()
        if bundle:
            yield flush()

    return staged(kinds(pages, least, id_col, payload_col).mapInArrow(run, "page_id long, file string, frame int, offset long, size long"), "warc-index")


def read_archives(index: DataFrame, payloads: bool = False) -> DataFrame:
    """Records read back by their places: page_id, payload_bytes, payload_digest, record_type, refers_to, and as asked url and payload (of responses)."""
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())] + [("url", pa.string()), ("payload", pa.binary())] * payloads
    number = lambda text: None if text is None else int(text)

    def row_of(h: dict[str, str], block: bytes) -> list:
        head, _, body = block.partition(b"\r\n\r\n")
        size = int(head.rsplit(b"Content-Length: ", 1)[1])
        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
        if h["WARC-Type"] == "response" and (base32_sha1(body) != digest or len(body) != size):
            raise ValueError(f"{h['WARC-Record-ID']} is damaged")
        row = [number(h.get("X-Page-ID")), size, digest, h["WARC-Type"], number(h.get("X-Refers-To-Page-ID"))]
        if payloads:
            row += [json.loads(h["X-Target-URI-JSON"]) if "X-Target-URI-JSON" in h else h["WARC-Target-URI"], body if h["WARC-Type"] == "response" else None]
        return row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle: Bundle | None = None
        number, data = -1, b""
        for batch in batches:
            rows, held = [], 0
            for file, frame, offset, size in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if bundle is None or bundle.file != file:
                    bundle, number = Bundle(file), -1
                if number != frame:
                    number, data = frame, bundle.frame(frame)
                rows.append(row_of(*next(parse(data[offset : offset + size]))))
                held += size * payloads
                if held > FRAME_BYTES * 16:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(map(list, zip(*rows)), fields)], [n for n, _ in fields])
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(map(list, zip(*rows)), fields)], [n for n, _ in fields])

    files = max(1, index.select("file").distinct().count())
    places = index.select("file", "frame", "offset", "size").repartition(files, "file").sortWithinPartitions("file", "frame", "offset")
    return places.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", url string, payload binary" * payloads)


def archive(pages: DataFrame, least: int = 0, **names) -> DataFrame:
    """Write bundles and read them back: the table of read_archives."""
    return read_archives(write_archives(pages, fresh_path(pages.sparkSession, "warc"), least, **names))
