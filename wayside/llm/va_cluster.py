"""Centroid clustering over a VA-file.

The vectors are written once with their approximation: each of 64 integer components
falls into one of 2^bits cells of its dimension, packed into bits x 8 bytes. For a round
every centroid has a table of the least and the largest squared difference to each cell;
summed over the dimensions they give an interval of its distance to a vector, from the
cells alone. Only where the intervals of several centroids overlap at the low end is the
full vector fetched and its distance to these centroids computed. As cells bound their
components, the assignment is exact whatever the cells are.

A round is one pass over the file without a shuffle of vectors: the full vector lies
beside its cells, as the round's sums take each vector once. A task adds up its clusters;
only these sums (k x 65 numbers a task) are shuffled. The driver holds k centroids.

Cells are cut at quantiles of at most sample_rows vectors (the smallest by a hash);
the outermost cells reach to the least and largest component of all rows.

Defined results: only vectors of exactly `size` components take part, none null, NaN or
infinite; others give no row. Equal hashes of ids (repeated ids) are started in the order
of their components; a null id hashes as `1:`. With under k vectors there are as many
centroids as vectors. Components, times the scale, have to stay within 2^26 or the job
stops with an error, as squared distances would not fit a long. Rows that repeat count
each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from wayside.llm.common import materialise

SIZE = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
BITS = 6
SAMPLE_ROWS = 16384
MOST = 1 << 26
SLICE_ROWS = 1 << 13


class Cells:
    """Per dimension the least and largest component of each cell, and the cuts between them."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int = BITS):
        dims, count = len(low), 1 << bits
        self.bits = bits
        self.cuts = np.full((dims, count - 1), np.iinfo(np.int64).max)
        self.low, self.high = np.repeat(high[:, None], count, axis=1), np.repeat(high[:, None], count, axis=1)
        for d in range(dims):
            values = np.unique(sample[:, d])
            if len(values) > count - 1:
                values = np.unique(np.quantile(sample[:, d], np.arange(1, count) / count, method="lower"))
            cuts = values[values > low[d]]
            self.cuts[d, : len(cuts)] = cuts
            self.low[d, 0] = low[d]
            self.low[d, 1 : len(cuts) + 1] = cuts
            self.high[d, : len(cuts)] = cuts - 1

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Rows of packed cells."""
        cells = np.stack([np.searchsorted(cuts, x[:, d], "right") for d, cuts in enumerate(self.cuts)], axis=1).astype(np.uint8)
        planes = cells[:, :, None] >> np.arange(self.bits, dtype=np.uint8) & 1
        return np.packbits(planes.reshape(len(x), -1), axis=1, bitorder="little")

    def decode(self, packed: np.ndarray) -> np.ndarray:
        dims = len(self.cuts)
        planes = np.unpackbits(packed, axis=1, count=dims * self.bits, bitorder="little").reshape(len(packed), dims, self.bits)
        return np.left_shift(planes, np.arange(self.bits, dtype=np.uint8)).sum(2, dtype=np.uint8)

    def tables(self, centroids: np.ndarray) -> np.ndarray:
        """(dimension, cell, 2 k): the least squared differences to each centroid, then the largest."""
        c = centroids.T[:, None, :]
        to_low, to_high = (self.low[:, :, None] - c) ** 2, (self.high[:, :, None] - c) ** 2
        inside = (self.low[:, :, None] <= c) & (c <= self.high[:, :, None])
        return np.concatenate([np.where(inside, 0, np.minimum(to_low, to_high)), np.maximum(to_low, to_high)], axis=2)


def assign(cells: np.ndarray, fetch, tables: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (ties: the smaller number), and which rows had to be fetched.
    fetch(rows) gives full vectors of rows whose intervals overlap."""
    k = len(centroids)
    total = np.zeros((len(cells), 2 * k), np.int64)
    for d, table in enumerate(tables):
        total += table[cells[:, d]]
    least, largest = total[:, :k], total[:, k:]
    near = least <= largest.min(1, keepdims=True)
    cluster = near.argmax(1)
    fetched = near.sum(1) > 1
    rows = np.flatnonzero(fetched)
    if len(rows):
        x, near = fetch(rows), near[rows]
        far = np.iinfo(np.int64).max
        exact = np.stack([np.where(near[:, j], _squared(x, c, near[:, j]), far) for j, c in enumerate(centroids)], axis=1)
        cluster[rows] = exact.argmin(1)
    return cluster, fetched


def _squared(x: np.ndarray, centroid: np.ndarray, where: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    out[where] = ((x[where] - centroid) ** 2).sum(1)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _packed(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _encoded(cells: Cells):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                if max(x.max(), -(x.min() + 1)) >= MOST:
                    raise ValueError(f"a scaled component is beyond {MOST}: squared distances would not fit a long")
                packed = cells.encode(x)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(bytes, packed)), pa.binary()), batch.column(1)], ["vec_id", "cells", "x"])

    return run


def _slices(batch: pa.RecordBatch):
    for at in range(0, batch.num_rows, SLICE_ROWS):
        yield batch.slice(at, SLICE_ROWS)


def _sums(cells: Cells, centroids: np.ndarray):
    """Of a task: for each cluster the number and the component sums of its vectors, and how many were fetched."""
    tables = cells.tables(centroids)

    def run(batches):
        k = len(centroids)
        out, fetched = np.zeros((k, 1 + centroids.shape[1]), np.int64), 0
        for batch in batches:
            for part in _slices(batch):
                x = _matrix(part.column(1))
                cluster, far = assign(cells.decode(_packed(part.column(0))), lambda rows, x=x: x[rows], tables, centroids)
                fetched += int(far.sum())
                order = np.argsort(cluster, kind="stable")
                found, first = np.unique(cluster[order], return_index=True)
                out[found, 0] += np.diff(np.append(first, len(order)))
                out[found, 1:] += np.add.reduceat(x[order], first, axis=0)
        flat = np.append(out.ravel(), fetched)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["slot", "v"])

    return run


def _assigned(cells: Cells, centroids: np.ndarray):
    tables = cells.tables(centroids)

    def run(batches):
        for batch in batches:
            for part in _slices(batch):
                x = _matrix(part.column(2))
                cluster, far = assign(cells.decode(_packed(part.column(1))), lambda rows, x=x: x[rows], tables, centroids)
                distance = ((x - centroids[cluster]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster, pa.int32()), pa.array(distance), pa.array(far)], ["vec_id", "cluster", "distance", "fetched"])

    return run


def scaled(vectors: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """(vec_id, x): the vectors that take part, as integers floor(scale * component)."""
    e = F.col(vector_col).cast("array<double>")
    fine = F.coalesce((F.size(e) == size) & F.forall(e, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))), F.lit(False))
    return vectors.filter(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(e, lambda c: F.floor(c * float(scale))).alias("x"))


def fit_cells(x: DataFrame, size: int, bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> Cells | None:
    """Cells from the quantiles of a bounded sample, with the range of all rows; none for an empty table."""
    ends = x.agg(*[f(F.get("x", d)) for f in (F.min, F.max) for d in range(size)]).first()
    if ends[0] is None:
        return None
    sample = [r[0] for r in x.select("x").orderBy(F.xxhash64("x"), "x").limit(sample_rows).collect()]
    return Cells(np.array(sample, np.int64), np.array(ends[:size], np.int64), np.array(ends[size:], np.int64), bits)


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and fetched (whether the
    last assignment took the full vector): one row per vector that takes part."""
    spark = vectors.sparkSession
    x = scaled(vectors, id_col, vector_col, size, scale)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, fetched boolean"
    cells = fit_cells(x, size, bits, sample_rows)
    if cells is None:
        return spark.createDataFrame([], schema)
    file = materialise(x.mapInArrow(_encoded(cells), "vec_id long, cells binary, x array<long>"))
    named = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = np.array([r.x for r in file.select(named.alias("h"), "x").orderBy("h", "x").limit(k).collect()], np.int64)
    for _ in range(rounds):
        slots = file.select("cells", "x").mapInArrow(_sums(cells, centroids), "slot long, v long").groupBy("slot").agg(F.sum("v").alias("v"))
        sums = np.zeros(len(centroids) * (size + 1) + 1, np.int64)
        for r in slots.collect():  # k x 65 numbers
            sums[r.slot] = r.v
        sums = sums[:-1].reshape(len(centroids), size + 1)
        held = sums[:, 0] > 0
        centroids = centroids.copy()
        centroids[held] = sums[held, 1:] // sums[held, :1]
    done = materialise(file.mapInArrow(_assigned(cells, centroids), "vec_id long, cluster int, distance long, fetched boolean"))
    inertia = {r.cluster: r.s for r in done.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([Row(cluster=j, cluster_inertia=inertia.get(j, 0), inertia=sum(inertia.values()), centroid_sha256=d) for j, d in enumerate(digests)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "fetched")
