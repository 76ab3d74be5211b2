"""Suffix-array dedup with deep-shallow sorting.

A byte is removed if a `width`-byte string over it also starts in a document with a
smaller id. Only suffixes that can repeat are sorted. Every `width`-byte window has
an anchor: its k-byte string with the smallest hash; equal windows have equal
anchors. Anchor hashes that several documents hold pick the contexts (all windows
around an anchor) to be compared, dealt by anchor hash. Within a shard the windows'
suffixes are sorted to `width` bytes: multikey quicksort on 8-byte characters down
to the shallow depth, then blind tries for the groups still tied, built level by
level for all groups at once (each member is compared once with its group's leaf,
and members with the same branch stay together). Neighbours that tie to the full
depth are equal windows, and the smallest document of each class decides.

Whole copies are settled by their SHA-256 before that. Contexts that several
documents of a batch share are sent once, by the smallest document, the others are
settled in the batch; so a very common passage reaches a shard once a batch.
Hashes only choose what is compared; equality is always of bytes.

Defined results: null text is empty; a null id is larger than every id; rows with
equal ids never remove from each other; texts shorter than `width` keep all; an
empty table gives an empty result; other columns are ignored. The input has to be
a stored table (it is read several times).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import materialise, mix64, pack_sorted, split_rows, text_bytes, unpack_sorted

WIDTH = 50
K = 16
SHALLOW = 16
BATCH_BYTES = 2 << 20
SHARD_BYTES = 6 << 20
GROUP_BITS = 8
BROADCAST_ROWS = 1 << 20
HASH_MASK = np.uint64((1 << 48) - 1)
NULL_RANK = (1 << 63) - 1


def _slide(values: np.ndarray, w: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over all runs of w values."""
    have, step = 1, values
    while 2 * have <= w:
        step = pick(step[:-have], step[have:]) if len(step) > have else step[:0]
        have *= 2
    rest = w - have
    return pick(step[: len(step) - rest], step[rest:]) if rest and len(step) > rest else step[: max(0, len(step) - rest)]


def window_hashes(data: np.ndarray, k: int = K) -> np.ndarray:
    """A hash of each k-byte string (8 <= k <= 16)."""
    if len(data) < k:
        return np.zeros(0, np.uint64)
    words = np.ndarray(len(data) - 7, np.uint64, np.ascontiguousarray(data), strides=(1,))
    n = len(data) - k + 1
    return mix64(words[:n] * np.uint64(0x9E3779B97F4A7C15) ^ mix64(words[k - 8 : k - 8 + n]))


def anchors(data: np.ndarray, width: int = WIDTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions of one text, their 48-bit keys, and each window's key. Keys are
    mixed again: anchors have small hashes, which would all fall into the first shards."""
    if len(data) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = window_hashes(data, k) & HASH_MASK
    w = width - k + 1
    least = _slide(h, w, np.minimum)
    padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    at = np.flatnonzero(_slide(padded, w, np.maximum) == h)
    return at, mix64(h[at]) & HASH_MASK, mix64(least) & HASH_MASK


def load8(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as big-endian integers, so that they sort as text."""
    words = np.ndarray(len(flat) - 7, ">u8", flat, strides=(1,))
    return words[at].astype(np.uint64)


def deep_shallow(flat: np.ndarray, starts: np.ndarray, depth: int = WIDTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first `depth` bytes, and the class of each
    place in that order (equal classes: equal bytes). flat has 8 spare bytes at its end."""
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)  # first place of the group, in order
    for d in range(0, shallow, 8):  # multikey quicksort on 8-byte characters
        open_ = np.flatnonzero(_tied(group))
        if not len(open_):
            break
        char = load8(flat, starts[order[open_]] + d)
        g = group[open_]
        s = np.lexsort((char, g))
        order[open_] = order[open_][s]
        char, g = char[s], g[s]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (char[1:] != char[:-1])])
        group[open_] = open_[np.flatnonzero(new)][np.cumsum(new) - 1]
    closed = np.zeros(len(starts), bool)  # equal to the full depth
    words = range(shallow, depth, 8)
    while True:  # blind tries, one level of all of them at a time
        open_ = np.flatnonzero(_tied(group) & ~closed)
        if not len(open_):
            break
        g = group[open_]
        mine, leaf = starts[order[open_]], starts[order[g]]
        branch = np.full(len(open_), depth, np.int64)
        byte, other = np.zeros(len(open_), np.int64), np.zeros(len(open_), np.int64)
        left = np.arange(len(open_))
        for d in words:
            a, b = load8(flat, mine[left] + d), load8(flat, leaf[left] + d)
            if depth - d < 8:
                a, b = (x >> np.uint64(8 * (8 - depth + d)) << np.uint64(8 * (8 - depth + d)) for x in (a, b))
            differ = a != b
            x = a[differ] ^ b[differ]
            place = _leading_bytes(x)
            hit = left[differ]
            branch[hit] = d + place
            shift = (np.uint64(56) - (place * 8).astype(np.uint64))
            byte[hit] = (a[differ] >> shift & np.uint64(255)).astype(np.int64)
            other[hit] = (b[differ] >> shift & np.uint64(255)).astype(np.int64)
            left = left[~differ]
            if not len(left):
                break
        before = (branch < depth) & (byte < other)
        side = np.where(before, branch - depth - 1, np.where(branch == depth, 0, depth + 1 - branch))
        s = np.lexsort((byte, side, g))
        order[open_] = order[open_][s]
        g, side, byte, equal = g[s], side[s], byte[s], branch[s] == depth
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (side[1:] != side[:-1]) | (byte[1:] != byte[:-1])])
        group[open_] = open_[np.flatnonzero(new)][np.cumsum(new) - 1]
        closed[open_] = equal
    return order, group


def _tied(group: np.ndarray) -> np.ndarray:
    same = group[1:] == group[:-1]
    return np.concatenate([same, [False]]) | np.concatenate([[False], same])


def _leading_bytes(x: np.ndarray) -> np.ndarray:
    """Whole zero bytes at the top of non-zero 64-bit values."""
    out = np.zeros(len(x), np.int64)
    for shift in (32, 16, 8):
        low = x >> np.uint64(64 - shift) == 0
        out[low] += shift // 8
        x = np.where(low, x << np.uint64(shift), x)
    return out


def _set_bits(masks: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bit of every set bit of 64-bit masks, in order."""
    return np.nonzero(np.unpackbits(np.ascontiguousarray(masks, "<u8").view(np.uint8).reshape(-1, 8), axis=1, count=width, bitorder="little"))


def repeated_windows(contexts: np.ndarray, masks: np.ndarray, ranks: np.ndarray, width: int = WIDTH, k: int = K, shallow: int = SHALLOW) -> np.ndarray:
    """Of each context's windows (bit o: the window at byte o), those that a smaller rank has too."""
    size = contexts.shape[1]
    key = np.ascontiguousarray(np.concatenate([contexts, masks.astype("<u8").view(np.uint8).reshape(-1, 8)], axis=1)).view(f"V{size + 8}")[:, 0]
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, bool)
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(new) - 1
    first = order[np.flatnonzero(new)]
    lowest = np.full(len(first), NULL_RANK, np.int64)
    np.minimum.at(lowest, which, ranks)
    flat = np.concatenate([contexts[first].ravel(), np.zeros(8, np.uint8)])
    owner, offset = _set_bits(masks[first], width - k + 1)
    places, cls = deep_shallow(flat, owner * size + offset, width, shallow)
    best = np.full(len(places), NULL_RANK, np.int64)
    np.minimum.at(best, cls, lowest[owner[places]])
    smaller = np.zeros(len(places), bool)
    smaller[places] = best[cls] < lowest[owner[places]]
    partial = np.bitwise_or.reduceat(np.where(smaller, np.uint64(1) << offset.astype(np.uint64), np.uint64(0)), np.searchsorted(owner, np.arange(len(first)))) if len(owner) else np.zeros(len(first), np.uint64)
    return np.where(ranks > lowest[which], masks, partial[which])


# -- Spark --

ENTRIES = "shard int, grp long, keys binary, rows binary"


def _anchor_entries(shards: int):
    """Distinct anchor hashes of each document, packed by shard and group of documents."""

    def run(batches):
        for batch in batches:
            uid, column = batch.column(0).to_numpy(), batch.column(1)
            data, offsets = text_bytes(column)
            for g in np.unique(uid >> GROUP_BITS):
                rows = np.flatnonzero(uid >> GROUP_BITS == g)
                found = [np.unique(anchors(data[offsets[r] : offsets[r + 1]])[1]) for r in rows]
                keys = np.concatenate(found)
                docs = np.repeat(uid[rows] & ((1 << GROUP_BITS) - 1), list(map(len, found))).astype(np.uint8)
                order = np.lexsort((docs, keys))
                keys, docs = keys[order], docs[order]
                cuts = np.searchsorted(keys * np.uint64(shards) >> np.uint64(48), np.arange(shards + 1))
                out = [(k, pack_sorted(keys[a:b]), docs[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([int(g)] * len(out), pa.int64()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary())], ["shard", "grp", "keys", "rows"])

    return run


def _shared_anchors(table: pa.Table) -> pa.Table:
    """For each group of documents, its anchor hashes that another document holds too."""
    keys = [unpack_sorted(x.as_py()) for x in table["keys"]]
    cuts = np.cumsum([0, *map(len, keys)])
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    s = every[order]
    same = np.concatenate([[False], s[1:] == s[:-1], [False]])
    shared = np.zeros(len(every), bool)
    shared[order] = same[1:] | same[:-1]
    out = []
    for g, k, rows, a, b in zip(table["grp"].to_pylist(), keys, table["rows"].to_pylist(), cuts[:-1], cuts[1:], strict=True):
        if (mask := shared[a:b]).any():
            out.append((g, k[mask].tobytes(), np.frombuffer(rows, np.uint8)[mask].tobytes()))
    return pa.table({"grp": pa.array([x[0] for x in out], pa.int64()), "keys": pa.array([x[1] for x in out], pa.binary()), "rows": pa.array([x[2] for x in out], pa.binary())})


def _by_document(value: str, kind):
    """Packed (document in group, value) lists of a group, as one packed list for each document."""

    def run(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table["rows"]])
        keys = np.concatenate([np.frombuffer(x.as_py(), kind) for x in table[value]])
        g = table["grp"][0].as_py() << GROUP_BITS
        order = np.argsort(rows, kind="stable")
        docs, first = np.unique(rows[order], return_index=True)
        parts = np.split(keys[order], first[1:])
        return pa.table({"uid": pa.array(docs.astype(np.int64) + g), value: pa.array([x.tobytes() for x in parts], pa.binary())})

    return run


CONTEXTS = "shard int, contexts binary, masks binary, docs binary, uids binary, ranks binary, places binary, settled binary"


def _contexts(shards: int, width: int = WIDTH, k: int = K):
    """Contexts of the shared anchors, each once a batch; what the batch settles by itself rides along."""
    w = width - k + 1
    size = 2 * (w - 1) + k

    def run(batches):
        for batch in batches:
            for lo, hi in split_rows(text_bytes(batch.column(2))[1], BATCH_BYTES):
                part = batch.slice(lo, hi - lo)
                uid, rank = part.column(0).to_numpy(), part.column(1).to_numpy()
                data, offsets = text_bytes(part.column(2))
                got = []
                for r in range(hi - lo):
                    text = data[offsets[r] : offsets[r + 1]]
                    at, h, least = anchors(text, width, k)
                    keep = np.isin(h, np.frombuffer(part.column(3)[r].as_buffer(), np.uint64))
                    at, h = at[keep], h[keep]
                    if not len(at):
                        continue
                    edge = np.concatenate([np.zeros(w - 1, np.uint8), text, np.zeros(w - 1, np.uint8)])
                    q = at[:, None] + np.arange(-(w - 1), 1)
                    inside = (q >= 0) & (q < len(least))
                    own = inside & (least[np.clip(q, 0, len(least) - 1)] == h[:, None])
                    mask = (own.astype(np.uint64) << np.arange(w, dtype=np.uint64)).sum(1, dtype=np.uint64)
                    got.append((edge[at[:, None] + np.arange(size)], mask, h, at, np.full(len(at), r)))
                if not got:
                    continue
                ctx, mask, h, at, row = (np.concatenate(x) for x in zip(*got, strict=True))
                key = np.ascontiguousarray(np.concatenate([ctx, mask.view(np.uint8).reshape(-1, 8)], axis=1)).view(f"V{size + 8}")[:, 0]
                order = np.lexsort((rank[row], mix64(h)))
                order = order[np.argsort(key[order], kind="stable")]
                new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
                lowest = rank[row[order[np.flatnonzero(new)]]][np.cumsum(new) - 1]
                later = np.zeros(len(h), bool)
                later[order] = rank[row[order]] > lowest
                settled = np.stack([uid[row[later]], at[later], mask[later].view(np.int64)], axis=1).tobytes()
                send = np.flatnonzero(~later)
                shard = (h[send] * np.uint64(shards) >> np.uint64(48)).astype(np.int64)
                send = send[np.argsort(shard, kind="stable")]
                cuts = np.searchsorted(np.sort(shard), np.arange(shards + 1))
                out = []
                for s in range(shards):
                    x = send[cuts[s] : cuts[s + 1]]
                    if len(x):
                        mine, local = np.unique(row[x], return_inverse=True)
                        out.append((s, ctx[x].tobytes(), mask[x].tobytes(), local.astype(np.int32).tobytes(), uid[mine].tobytes(), rank[mine].tobytes(), at[x].tobytes(), b""))
                if len(settled):
                    out.append((int(uid[0] % shards), b"", b"", b"", b"", b"", b"", settled))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), *(pa.array([x[i] for x in out], pa.binary()) for i in range(1, 8))], [x.split()[0] for x in CONTEXTS.split(", ")])

    return run


def _repeats(width: int = WIDTH, k: int = K, shallow: int = SHALLOW):
    """Repeated window starts of a shard, packed by group of documents."""
    w = width - k + 1
    size = 2 * (w - 1) + k

    def run(table: pa.Table) -> pa.Table:
        column = lambda c, t: np.concatenate([np.frombuffer(x.as_py(), t) for x in table[c]])
        lengths = [len(x.as_py()) // 8 for x in table["uids"]]
        base = np.repeat(np.cumsum([0, *lengths])[:-1], [len(x.as_py()) // 4 for x in table["docs"]])
        docs = column("docs", np.int32) + base
        uid, places = column("uids", np.int64)[docs], column("places", np.int64)
        mask = repeated_windows(column("contexts", np.uint8).reshape(-1, size), column("masks", np.uint64), column("ranks", np.int64)[docs], width, k, shallow)
        settled = column("settled", np.int64).reshape(-1, 3)
        uid, places, mask = np.concatenate([uid, settled[:, 0]]), np.concatenate([places, settled[:, 1]]), np.concatenate([mask, settled[:, 2].view(np.uint64)])
        some = mask > 0
        uid, places, mask = uid[some], places[some], mask[some]
        i, o = _set_bits(mask, w)
        # runs of windows whose starts follow each other: start of the first and end of the last
        brk = np.concatenate([[True], (i[1:] != i[:-1]) | (o[1:] != o[:-1] + 1)]) if len(i) else np.zeros(0, bool)
        first = np.flatnonzero(brk)
        last = np.append(first[1:], len(i)) - 1 if len(i) else first
        start = places[i[first]] - (w - 1) + o[first]
        spans = np.stack([start, start + (o[last] - o[first]) + width], axis=1)
        who = uid[i[first]]
        order = np.argsort(who, kind="stable")
        who, spans = who[order], spans[order]
        groups, at = np.unique(who >> GROUP_BITS, return_index=True)
        return pa.table(
            {
                "grp": pa.array(groups),
                "spans": pa.array([x.tobytes() for x in np.split(spans, at[1:])] if len(groups) else [], pa.binary()),
                "rows": pa.array([(x & ((1 << GROUP_BITS) - 1)).astype(np.uint8).tobytes() for x in np.split(who, at[1:])] if len(groups) else [], pa.binary()),
            }
        )

    return run


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Maximal runs covered by [start, end) pairs."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(batches):
    for batch in batches:
        out = []
        for doc, text, spans in zip(*(batch.column(i) for i in range(3)), strict=True):
            raw = text.as_py().encode()
            runs = merge_spans(np.frombuffer(spans.as_buffer(), np.int64).reshape(-1, 2))
            digest, at = hashlib.sha256(), 0
            for a, b in runs.tolist():
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at:])
            out.append((doc.as_py(), len(raw), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([*(pa.array([x[i] for x in out], pa.int64()) for i in range(4)), pa.array([x[4] for x in out], pa.string())], [x.split()[0] for x in CUT.split(", ")])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, shallow: int = SHALLOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per document."""
    texts = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    info = materialise(texts.select("uid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")))
    rank = F.coalesce("doc_id", F.lit(NULL_RANK))
    first = info.groupBy("sha").agg(F.min(rank).alias("low"), F.count("*").alias("c")).filter("c > 1").drop("c")
    marked = info.join(first, "sha", "left").withColumn("copy", F.coalesce(rank > F.col("low"), F.lit(False)))
    marked = materialise(marked.select("uid", "doc_id", "n_bytes", "sha", "copy"))
    size = marked.filter("not copy").agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(12, -(-size // shard_bytes))
    copies = materialise(marked.filter("copy").select("uid"))
    if copies.count() <= BROADCAST_ROWS:  # the texts then stay in their order, and documents of a group together
        rest = texts.join(F.broadcast(copies), "uid", "left_anti")
    else:
        group = F.shiftright("uid", GROUP_BITS)
        rest = texts.join(copies, "uid", "left_anti").repartition(group).sortWithinPartitions("uid")
    entries = rest.select("uid", "text").mapInArrow(_anchor_entries(shards), ENTRIES)
    shared = entries.groupBy("shard").applyInArrow(_shared_anchors, "grp long, keys binary, rows binary")
    flags = materialise(shared.groupBy("grp").applyInArrow(_by_document("keys", np.uint64), "uid long, keys binary"))
    held = rest.join(flags, "uid").select("uid", rank.alias("rank"), "text", "keys")
    repeats = held.mapInArrow(_contexts(shards), CONTEXTS).groupBy("shard").applyInArrow(_repeats(shallow=shallow), "grp long, spans binary, rows binary")
    spans = materialise(repeats.groupBy("grp").applyInArrow(_by_document("spans", np.dtype("V16")), "uid long, spans binary"))
    cut = texts.join(spans, "uid").select("doc_id", "text", "spans").mapInArrow(_cut, CUT)
    whole = marked.join(spans.select("uid"), "uid", "left_anti")
    gone = F.col("copy") & (F.col("n_bytes") >= WIDTH)
    plain = whole.select("doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(0).alias("n_removed"), F.when(gone, 1).otherwise(0).cast("long").alias("n_spans"), F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("sha")).alias("kept_sha256"))
    return cut.union(plain)
