"""Shared pieces of the training-data operators: the shared folder, id helpers,
vectorised word hashing and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these bytes.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
SEGMENT_BYTES = 1 << 21


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); a temporary one
    is set only where the session names none, as in local tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialise(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage is cut, and
    a lost executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/wayside-{uuid.uuid4().hex}"
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mounted(folder: str) -> str:
    """The local name of a folder that tasks open by themselves; it has to be a mounted path."""
    path = re.sub(r"^file:/*", "/", folder)
    if ":" in path.split("/")[0]:
        raise ValueError(f"{folder}: the folder has to be a mounted path (file:)")
    return path


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """From now on Arrow batches of this session hold about `most` bytes at most (a longer row stands
    alone), as rows may be texts or bitmaps of any length; a limit that was set with a unit, or lower, is left as it is."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark.conf.get(name)  # a number of bytes, or one with a unit
    if size.rstrip("b").isdigit() and int(size.rstrip("b")) > most:
        spark.conf.set(name, str(most))


def save_array(path: str, array: np.ndarray) -> None:
    """Written under another name first, so a reader or a second attempt never meets half a file."""
    part = f"{path}.{os.getpid()}.part"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, path)


def give_back() -> None:
    """Return freed memory of this worker to the system, as reused workers would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A function of one group that gives its memory back when its tables are done with."""

    def grouped(table: pa.Table) -> pa.Table:
        out = run(table)
        give_back()
        return out

    return grouped


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """(uid) of at most `most` of these (uid, id): the smallest by a hash of the id, then by place.
    Where there are many more, most are left out before they are ordered."""
    scale = 1 << 30
    share = min(1.0, 2 * most / max(1, rows.count()))
    near = rows.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(scale)) < int(share * scale)) if share < 1 else rows
    return near.orderBy(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(scale)), "id", "uid").limit(most).select("uid")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(column: str, modulus: int):
    """crc32(id as text) mod modulus; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def shard_count(spark: SparkSession, units: int, per_shard: int) -> int:
    """Shards in proportion to the work, and at least one for each shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(units) // per_shard), 1)


# -- vectorised text ---------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_rows(offsets: np.ndarray, limit: int = SEGMENT_BYTES) -> list[tuple[int, int]]:
    """Row ranges of at most about limit bytes each (a longer text stands alone)."""
    out, lo, n = [], 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        out.append((lo, min(hi, n)))
        lo = out[-1][1]
    return out


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_ODD = np.uint64(0x9E3779B97F4A7C15)
_ALL = np.uint64((1 << 64) - 1)
LONG_RUN = 64


def hash_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs. Eight bytes at a time are mixed into what came
    before, so runs of up to eight bytes that differ never share a hash with others
    of their length; runs of over LONG_RUN bytes are hashed by BLAKE2b."""
    lengths = lengths.astype(np.int64, copy=False)
    h = mix64((lengths.astype(np.uint64) + np.uint64(1)) * _ODD)
    words = np.ndarray(len(data) + 1, np.uint64, np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    long = lengths > LONG_RUN
    todo = np.flatnonzero(~long & (lengths > 0))
    for d in range(0, LONG_RUN, 8):
        todo = todo[lengths[todo] > d]
        if not len(todo):
            break
        spare = np.maximum(8 - (lengths[todo] - d), 0).astype(np.uint64)
        h[todo] = mix64(h[todo] ^ (words[starts[todo] + d] & (_ALL >> (spare * np.uint64(8)))))
    for i in np.flatnonzero(long).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : starts[i] + lengths[i]].tobytes(), digest_size=8).digest(), "little")
    return h


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in order, and for each text the index of its first word (n + 1 values)."""
    space = _IS_SPACE[data]
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = True
        before[1:] = space[:-1]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        before[inner] = True
    starts = np.flatnonzero(~space & before)
    after = np.ones(len(data), bool)
    if len(data):
        after[:-1] = space[1:] | before[1:] & ~space[1:]
    return starts, np.flatnonzero(~space & after) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased) in order, and for each text
    the index of its first word (n + 1 values). Works in slices cut between words."""
    starts, ends, firsts = word_bounds(data, offsets)
    hashes, lo = [], 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + SEGMENT_BYTES)))
        s, e = starts[lo:hi], ends[lo:hi]
        hashes.append(hash_runs(_LOWER[data[s[0] : e[-1]]], s - s[0], e - s))
        lo = hi
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), firsts


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def pack_sorted(values: np.ndarray) -> bytes:
    """Increasing 64-bit values as deltas in the fewest whole bytes, one byte plane after another."""
    delta = np.diff(values, prepend=np.uint64(0))
    width = max(1, (int(delta.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + delta.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return np.cumsum(out.view(np.uint64)[:, 0], dtype=np.uint64)


# -- components --------------------------------------------------------------


def _are_stars(e: DataFrame) -> bool:
    """Whether every node of the edges u > v is either a centre or has one edge, to a centre."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("centre")).union(e.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("centre").alias("centre"))
    return ends.filter("out > 1 or out > 0 and centre > 0").count() == 0


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the edges; component is the smallest
    node reachable. Alternates large-star and small-star rounds until only stars are left;
    each round is a keyed minimum (pre-aggregated) and a join, and is written to the shared folder."""
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v")
    e = materialise(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _are_stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = materialise(small)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
