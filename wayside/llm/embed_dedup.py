"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, exact rerank.

Equal vectors are first grouped, so copies count but are not compared. A rotation
is learned (principal axes, then iterative quantisation) on at most sample_rows
vectors, and every vector gets a binary code of 64 bits: one a dimension, and where there
are fewer dimensions the others by random rotations of them, so that every table has
chunks of 16 true bits. The code is cut into 16-bit chunks, one Hamming table each; a chunk is filed once for
each of its bits with that bit left out, so two chunks within one bit of each other
meet in a bucket. Pairs in a bucket within max_hamming of each other are reranked
by cosine in double precision on the original vectors. A pair is taken only in the
first table and bucket where it can meet, so no pair is seen twice.

Scale: only codes and ids are dealt to the buckets, packed, 16 bytes an entry. A
bucket is compared in tiles of at most tile x tile entries; the tiles of larger
buckets become rows of their own and are dealt out again, so none is one task's
work. Every candidate is compared, nothing is capped. Links are as many as the
data have (their count is part of the result), each with its two vectors once.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with null id, link with nothing (n_links 0, own component);
vectors of other lengths than the sample's commonest are coded by 64 random
projections, and vectors of different length never link; an id that
repeats stands for several vectors; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import connected_components, materialise, mix64

SAMPLE_ROWS = 16384
MIN_COSINE = 0.95
CHUNK_BITS = 16
MAX_HAMMING = 18
TILE = 2048
SHARD_ENTRIES = 1 << 21


def learn_rotation(x: np.ndarray, bits: int, rounds: int = 40, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection of unit vectors to balanced, nearly binary coordinates."""
    mean = x.mean(0)
    centred = x - mean
    _, axes = np.linalg.eigh(centred.T @ centred / len(x))
    axes = axes[:, ::-1][:, :bits]
    projected = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        signs = np.where(projected @ turn >= 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(signs.T @ projected)
        turn = (u @ vt).T
    return mean, axes @ turn


def more_directions(dim: int, bits: int, seed: int = 5) -> np.ndarray:
    """Unit directions of which each dim are orthogonal: random rotations side by side."""
    rng = np.random.default_rng([seed, dim])
    turns = [np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :bits] for _ in range(-(-bits // dim))]
    return np.concatenate(turns, axis=1)[:, :bits]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes_of(x: np.ndarray, model: dict) -> np.ndarray:
    """64-bit codes of vectors of one length."""
    if x.shape[1] == model["dim"]:
        bits = (unit(x) - model["mean"]) @ model["rotation"] >= 0
    else:
        bits = x @ more_directions(x.shape[1], 64) >= 0
    out = np.zeros((len(x), 64), np.uint8)
    out[:, : bits.shape[1]] = bits
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)[:, 0]


def _rows_of(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (row numbers, matrix) of a list column without nulls."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets)
    return {int(n): (at := np.flatnonzero(sizes == n), flat[offsets[at][:, None] + np.arange(n)]) for n in np.unique(sizes)}


def fit(reps: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """The rotation, from the sample_rows smallest by a hash of the vector."""
    rows = [r[0] for r in reps.orderBy(F.xxhash64("embedding"), "embedding").select("embedding").limit(sample_rows).collect()]
    if not rows:
        return {"dim": -1, "bits": 64}
    dim = min(Counter(map(len, rows)).items(), key=lambda x: (-x[1], x[0]))[0]
    x = unit(np.array([r for r in rows if len(r) == dim], np.float64))
    mean, rotation = learn_rotation(x, min(64, dim))
    if dim < 64:
        rotation = np.concatenate([rotation, more_directions(dim, 64 - dim)], axis=1)
    return {"dim": dim, "bits": 64, "mean": mean, "rotation": rotation}


def _entries(model: dict, shards: int):
    """Packed bucket entries of a batch: for each shard the bucket keys, codes and ids."""

    def run(batches):
        for batch in batches:
            uid = batch.column(0).to_numpy()
            code, length = np.zeros(len(uid), np.uint64), np.zeros(len(uid), np.uint64)
            for n, (at, x) in _rows_of(batch.column(1)).items():
                code[at], length[at] = codes_of(x, model), n
            keys = []
            for table in range(64 // CHUNK_BITS):
                chunk = code >> np.uint64(table * CHUNK_BITS) & np.uint64((1 << CHUNK_BITS) - 1)
                for bit in range(CHUNK_BITS):
                    keys.append(mix64(length << np.uint64(32) ^ np.uint64((table * CHUNK_BITS + bit) << CHUNK_BITS) ^ chunk & ~np.uint64(1 << bit)) & ~np.uint64(63) | np.uint64(table * CHUNK_BITS + bit))
            keys = np.concatenate(keys)
            row = np.tile(np.arange(len(uid)), 64)
            shard = ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            out = [(k, keys[o].tobytes(), code[row[o]].tobytes(), uid[row[o]].tobytes()) for k in range(shards) if len(o := order[cuts[k] : cuts[k + 1]])]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), *(pa.array([x[i] for x in out], pa.binary()) for i in (1, 2, 3))], ["shard", "keys", "codes", "ids"])

    return run


def _meet_first(x: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether pairs that differ in x and share the bucket of this place meet in no earlier one."""
    mask = np.uint64((1 << CHUNK_BITS) - 1)
    table, bit = place // CHUNK_BITS, (place % CHUNK_BITS).astype(np.uint64)
    here = x >> (table * CHUNK_BITS).astype(np.uint64) & mask
    first = (here == np.uint64(1) << bit) | (here == 0) & (bit == 0)
    for t in range(64 // CHUNK_BITS):
        first &= (np.bitwise_count(x >> np.uint64(t * CHUNK_BITS) & mask) > 1) | (table <= t)
    return first


def _tile(place: int, a_code, a_id, b_code, b_id, same: bool, max_hamming: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile within max_hamming that meet in this bucket first."""
    x = a_code[:, None] ^ b_code[None, :]
    good = np.bitwise_count(x) <= max_hamming
    if same:
        good &= np.tri(len(a_id), len(b_id), -1, dtype=bool).T
    i, j = np.nonzero(good)
    first = _meet_first(x[i, j], np.full(len(i), place))
    return a_id[i[first]], b_id[j[first]]


TILES = "place int, same boolean, a_codes binary, a_ids binary, b_codes binary, b_ids binary"


def _buckets(tile: int, max_hamming: int, small: int = 32):
    """One shard's buckets: those of up to `small` entries are compared at once and
    give one row of pairs (place -1); larger ones become rows of tiles."""

    def run(table: pa.Table) -> pa.Table:
        keys, codes, ids = (np.concatenate([np.frombuffer(x.as_py(), t) for x in table[c]]) for c, t in (("keys", np.uint64), ("codes", np.uint64), ("ids", np.int64)))
        order = np.lexsort((ids, keys))
        keys, codes, ids = keys[order], codes[order], ids[order]
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        size = np.repeat(np.diff(edge), np.diff(edge))
        place = (keys & np.uint64(63)).astype(np.int64)
        left, right = [], []
        for d in range(1, small):
            i = np.flatnonzero((keys[d:] == keys[:-d]) & (size[:-d] <= small))
            x = codes[i] ^ codes[i + d]
            i = i[(np.bitwise_count(x) <= max_hamming) & _meet_first(x, place[i])]
            left.append(ids[i])
            right.append(ids[i + d])
        out = [(-1, False, b"", np.concatenate(left).tobytes(), b"", np.concatenate(right).tobytes())]
        for a in edge[:-1][np.diff(edge) > small].tolist():
            b = a + int(size[a])
            for s in range(a, b, tile):
                for t in range(s, b, tile):
                    x, y = slice(s, min(b, s + tile)), slice(t, min(b, t + tile))
                    out.append((int(place[a]), s == t, codes[x].tobytes(), ids[x].tobytes(), b"" if s == t else codes[y].tobytes(), b"" if s == t else ids[y].tobytes()))
        types = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], ["place", "same", "a_codes", "a_ids", "b_codes", "b_ids"])

    return run


def _compare(max_hamming: int):
    def run(batches):
        for batch in batches:
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for place, same, ac, ai, bc, bi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place < 0:
                    a.append(np.frombuffer(ai, np.int64))
                    b.append(np.frombuffer(bi, np.int64))
                    continue
                x = np.frombuffer(ac, np.uint64), np.frombuffer(ai, np.int64)
                y = x if same else (np.frombuffer(bc, np.uint64), np.frombuffer(bi, np.int64))
                i, j = _tile(place, *x, *y, same, max_hamming)
                a.append(i)
                b.append(j)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return run


def _rerank(min_cosine: float):
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = _rows_of(batch.column(2)), _rows_of(batch.column(3))
            for n in left.keys() & right.keys():
                at, i, j = np.intersect1d(left[n][0], right[n][0], return_indices=True)
                x, y = left[n][1][i], right[n][1][j]
                keep[at] = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)) >= min_cosine
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def candidate_pairs(vector: DataFrame, model: dict, rows: int, tile: int = TILE, max_hamming: int = MAX_HAMMING) -> DataFrame:
    """Pairs (a, b) of (uid, embedding) that the Hamming tables find, each once."""
    shards = max(12, -(-rows * 64 // SHARD_ENTRIES))
    tiles = vector.mapInArrow(_entries(model, shards), "shard int, keys binary, codes binary, ids binary").groupBy("shard").applyInArrow(_buckets(tile, max_hamming, min(32, tile)), TILES)
    return tiles.repartition(shards).mapInArrow(_compare(max_hamming), "a long, b long")


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = MIN_COSINE, max_hamming: int = MAX_HAMMING, sample_rows: int = SAMPLE_ROWS, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    single = vectors.sparkSession.createDataFrame([], "uid long, rep_id long, copies long, embedding array<double>")
    good = rows.filter(usable)
    reps = good.groupBy("embedding").agg(F.min("vec_id").alias("rep_id"), F.count("*").alias("copies"))
    reps = materialise(reps.select(F.monotonically_increasing_id().alias("uid"), "rep_id", "copies", "embedding")).unionByName(single)
    model = fit(reps, sample_rows)
    vector = reps.select("uid", "embedding")
    pairs = candidate_pairs(vector, model, reps.count(), tile, max_hamming)
    both = pairs.join(vector.toDF("a", "va"), "a").join(vector.toDF("b", "vb"), "b").select("a", "b", "va", "vb")
    links = materialise(both.mapInArrow(_rerank(min_cosine), "a long, b long"))
    copies = reps.select("uid", "copies")
    sides = links.union(links.select("b", "a")).toDF("uid", "other").join(copies.toDF("other", "n"), "other")
    linked = sides.groupBy("uid").agg(F.sum("n").alias("linked"))
    labels = connected_components(links).toDF("uid", "label")
    named = materialise(reps.drop("embedding").join(labels, "uid", "left").withColumn("label", F.coalesce("label", "uid")))
    lowest = named.groupBy("label").agg(F.min("rep_id").alias("component_id"))
    info = named.join(lowest, "label").join(linked, "uid", "left").select("uid", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = good.join(reps.select("uid", "embedding").join(info, "uid"), "embedding").select("vec_id", "n_links", "component_id")
    rest = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
