"""WARC archives in seekable Zstandard bundles.

Records are gathered into independent Zstandard frames of about frame_bytes, the
frames into bundle files, each closed by a footer seek table (a skippable frame
with the sizes of all frames). The index maps every record identifier to its
bundle, frame and offset inside the frame, so one record is read by decoding one
frame. Of records with equal payloads (SHA-256) one is a response and the others
are revisits that refer to it.

Bundles are written by the tasks to a folder under spark.checkpoint.dir, which
has to be a mounted path (file:). A task writes under a name of its own attempt
and renames when complete; readers open only the bundles that the index names,
so what a lost task left behind is never read. A frame, one record and a batch
of rows are held in memory at a time.

Payloads are compared by digest in a narrow table; the payloads themselves are not
dealt by content, so one that many pages share does not gather in a task. Archives are
read back by as many tasks as there are bundles.

Defined results: null html is an empty payload; null url leaves the target out;
control characters in a url are percent-encoded; page ids may be null (such a
page can only be the response if all ids of its payload are null) or repeat (all
rows with the smallest id are responses, and revisits refer to the first of them; a
row's place makes the record identifiers of the others differ); an empty table gives
an empty result. The input has to be a stored table (it is read twice).
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import materialise, mounted, shared_dir

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26
BROADCAST_ROWS = 1 << 20
# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
# Fixed values of the WARC 1.1 format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "1970-01-01T00:00:00Z"
INDEX = "record_id string, page_id long, bundle string, frame int, offset long"
RECORDS = "record_id string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, sha256: str, place: int | None = None) -> str:
    """Unique to the record; place tells a payload's records but the first apart, should they share a page id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{sha256}' + ('' if place is None else f'|{place}'))}>"


def record(page_id: int | None, url: str | None, payload: bytes, sha256: str, refers_to: int | None, revisit: bool, place: int | None = None) -> bytes:
    """One WARC record; page ids and the payload's length travel in extension fields."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, sha256, place)}", f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, sha256)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(frame: bytes, at: int = 0):
    """The records of a decoded frame from an offset on, as RECORDS tuples."""
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        head = dict(x.split(": ", 1) for x in frame[at:end].decode().split("\r\n")[1:])
        size = int(head["Content-Length"])
        block = frame[end + 4 : end + 4 + size]
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        at = end + 4 + size + 4
        url = head.get("WARC-Target-URI")
        page, refers = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
        if head["WARC-Type"] == "response" and (payload_digest(payload) != head["WARC-Payload-Digest"][5:] or len(payload) != int(head["X-Payload-Length"])):
            raise ValueError(f"damaged payload in {head['WARC-Record-ID']}")
        yield (
            head["WARC-Record-ID"],
            None if page is None else int(page),
            None if url is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
            head["WARC-Type"],
            None if refers is None else int(refers),
            int(head["X-Payload-Length"]),
            head["WARC-Payload-Digest"][5:],
            payload if head["WARC-Type"] == "response" else None,
        )


class BundleWriter:
    """Frames to one file, with the seek table at its end."""

    def __init__(self, path: str, frame_bytes: int = FRAME_BYTES):
        self.path, self.limit, self.frames, self.buffer, self.size, self.written = path, frame_bytes, [], [], 0, 0
        self.file = open(path + ".part", "wb")
        self.pack = zstandard.ZstdCompressor(level=3)

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset inside the frame of the record."""
        place = len(self.frames), self.size
        self.buffer.append(data)
        self.size += len(data)
        if self.size >= self.limit:
            self.flush()
        return place

    def flush(self) -> None:
        if self.buffer:
            packed = self.pack.compress(b"".join(self.buffer))
            self.file.write(packed)
            self.frames.append((len(packed), self.size))
            self.written += len(packed)
            self.buffer, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.file.write(seek_table(self.frames))
        self.file.close()
        os.replace(self.path + ".part", self.path)


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *x) for x in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, path: str):
        self.file = open(path, "rb")
        self.file.seek(-9, os.SEEK_END)
        count, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"no seek table in {path}")
        self.file.seek(-9 - 8 * count, os.SEEK_END)
        sizes = [struct.unpack("<II", self.file.read(8)) for _ in range(count)]
        self.starts, at = [], 0
        for packed, _ in sizes:
            self.starts.append((at, packed))
            at += packed

    def frame(self, k: int) -> bytes:
        start, size = self.starts[k]
        self.file.seek(start)
        return zstandard.ZstdDecompressor().decompress(self.file.read(size))

    def close(self) -> None:
        self.file.close()


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, sha256, refers_to, revisit, place: the smallest page_id of each payload of at least min_bytes is the response."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.monotonically_increasing_id().alias("uid"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    keyed = materialise(rows.select("uid", "page_id", F.length("payload").alias("n"), F.sha2("payload", 256).alias("sha256")))
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "uid")))
    groups = keyed.groupBy("sha256").agg(least.alias("least"), F.min("uid").alias("uid"), F.count("*").alias("c")).filter("c > 1")
    groups = groups.select("sha256", F.col("least.page_id").alias("first"), F.coalesce("least.uid", "uid").alias("first_uid"))
    revisit = F.coalesce((F.col("n") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    marks = keyed.join(groups, "sha256").filter("uid <> first_uid").select("uid", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"), F.col("uid").alias("place"))
    marks = materialise(marks)
    few = marks.count() <= BROADCAST_ROWS
    marked = rows.join(F.broadcast(marks) if few else marks, "uid", "left")
    return marked.select("page_id", "url", "payload", F.sha2("payload", 256).alias("sha256"), "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"), "place")


def write_warc(records: DataFrame, folder: str | None = None, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write the records' bundles to a new folder and return their index, already stored."""
    folder = folder or f"{shared_dir(records.sparkSession)}/warc-{uuid.uuid4().hex}"
    path = mounted(folder)

    def run(batches):
        context = TaskContext.get()
        os.makedirs(path, exist_ok=True)
        writer, count = None, 0
        for batch in batches:
            rows, places = batch.to_pylist(), []
            for r in rows:
                if writer is None:
                    writer = BundleWriter(f"{path}/{context.partitionId():06d}-{context.taskAttemptId()}-{count:05d}.warc.zst", frame_bytes)
                    count += 1
                places.append((writer.path, *writer.add(record(r["page_id"], r["url"], r["payload"], r["sha256"], r["refers_to"], r["revisit"], r["place"]))))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_arrays(
                [pa.array([record_id(r["page_id"], r["sha256"], r["place"]) for r in rows], pa.string()), batch.column(0), pa.array([x[0] for x in places], pa.string()), pa.array([x[1] for x in places], pa.int32()), pa.array([x[2] for x in places], pa.int64())],
                ["record_id", "page_id", "bundle", "frame", "offset"],
            )
        if writer is not None:
            writer.close()

    return materialise(records.mapInArrow(run, INDEX))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], [x.split()[0] for x in RECORDS.split(", ")])


def read_warc(index: DataFrame) -> DataFrame:
    """All records of the bundles that the index names, a task for each bundle."""
    bundles = materialise(index.select("bundle").distinct())
    count = max(1, bundles.count())

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                reader = BundleReader(path)
                for k in range(len(reader.starts)):
                    yield _batch(list(parse(reader.frame(k))))
                reader.close()

    return bundles.repartition(count).mapInArrow(run, RECORDS)  # a stated number is not coalesced


def fetch_records(wanted: DataFrame) -> DataFrame:
    """The records of some rows of the index, each by decoding its frame alone."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                reader = BundleReader(r["bundle"])
                yield _batch([next(parse(reader.frame(r["frame"]), r["offset"]))])
                reader.close()

    return wanted.select("record_id", "page_id", "bundle", "frame", "offset").mapInArrow(run, RECORDS)
