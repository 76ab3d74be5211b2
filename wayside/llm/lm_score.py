"""Language-model scoring with an Elias-Fano n-gram trie.

Level 1 holds the training vocabulary: sorted 64-bit word hashes as an Elias-Fano
sequence, a word's rank is its id. Level n holds, for each context (a node of level
n - 1, at level 2 also the start of a text), the nodes of level n - 1 that end in the
words that follow it at least min_count times: the word at level 2, the pair of the
context's last word and the next one at level 3. Monotone pointers give a context's
range, and the nodes, made monotone by adding context times their number, are searched
for the successor inside this range; a node's place is its id for the next level.
Probabilities from level 2 on are absolutely discounted, interpolated with the level
below, and quantised to 8 bits in log space, as are the weights left to the level below
in each context; level 1, and levels with one above them, refer to their few distinct
counts. Levels are cut into shards by hash and context range.

A counting pass for each level builds the levels and one map-only pass scores. Counts
are taken over all training texts: each task sends sorted distinct words, and then
delta-coded and squeezed distinct pairs of nodes, with local counts, to their context's
shard, which writes its part of the level. A hot context, one that at least one in 2^16
tokens follows, has its pairs dealt by a hash of both nodes instead; their sums are sent
on to shards of hot contexts, so a frequent word does not gather in a task. With
min_count 1 nothing that was seen is left out.
The levels are files in a folder under spark.checkpoint.dir (a mounted path), mapped by
the scoring tasks and kept out of their heaps; they grow with the distinct n-grams, and
their shards with the input.

Words that share a 64-bit hash are one word to the model. Defined results: null
and empty texts are the end token alone; ids may be null (they hash as empty
text) or repeat; without training documents every token is unknown and V is 0;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import crc_bucket, materialise, mounted, pack_sorted, save_array, shared_dir, split_rows, text_bytes, unpack_sorted, word_hashes
from wayside.llm.elias_fano import Sequence, write_sequence

BATCH_BYTES = 12 << 20
SHARD_BYTES = 24 << 20
MIN_COUNT = 2
ORDER = 2
MOST_NODES = (1 << 32) - 2
DISCOUNT = 0.75
HOT_SHARE = 1 << 16  # so there are at most as many hot contexts
END = np.uint64(0x5AFE0E0D0C0B0A09)
LEVELS = 255
LOG_SPAN = 12.0
PAIR_SHIFT = np.uint64(32)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard by hash range, in hash order."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def quantise(log10p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10p * (LEVELS / LOG_SPAN)), 0, LEVELS).astype(np.uint8)


def restore(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * (-LOG_SPAN / LEVELS)


def token_stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts with the end token after each, and the texts' token offsets."""
    hashes, firsts = word_hashes(*text_bytes(column))
    n = len(firsts) - 1
    out = np.insert(hashes, firsts[1:], END)
    return out, firsts + np.arange(n + 1)


def _squeezed(data: bytes) -> bytes:
    """Byte planes are far from uniform, so an entropy coder takes a good part of what is sent."""
    return zstandard.compress(data, 1)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as bytes, and those of 255 and more at full width behind them."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return _squeezed(small.tobytes() + counts[counts >= 255].astype(np.uint64).tobytes())


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    data = zstandard.decompress(data)
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data[n:], np.uint64)
    return out


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


PACKED = "shard int, keys binary, counts binary"


def _rows(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in parts], pa.int32()), pa.array([_squeezed(pack_sorted(x[1])) for x in parts], pa.binary()), pa.array([pack_counts(x[2]) for x in parts], pa.binary())], ["shard", "keys", "counts"]
    )


def _cut(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """Sorted keys split by shard; each shard's keys stay sorted."""
    order = np.argsort(shard, kind="stable")
    shard, keys, counts = shard[order], keys[order], counts[order]
    at = np.concatenate([np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])), [len(shard)]]) if len(shard) else [0]
    return _rows([(int(shard[a]), keys[a:b], counts[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)])


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [unpack_sorted(zstandard.decompress(x.as_py())) for x in table["keys"]]
    return merge(keys, [unpack_counts(x.as_py(), len(k)) for x, k in zip(table["counts"], keys, strict=True)])


def _narrow(codes: np.ndarray, distinct: int) -> np.ndarray:
    return codes.astype(np.uint8 if distinct <= 1 << 8 else np.uint16 if distinct <= 1 << 16 else np.uint32)


class Trie:
    """The levels of a folder, mapped when first used."""

    def __init__(self, path: str, shards: int, bases: list[list[int]], total: int, hot: dict[int, list[int]] | None = None):
        self.path, self.shards, self.bases, self.total = path, shards, [np.array(b, np.int64) for b in bases], total
        self.hot = {n: np.array(h, np.int64) for n, h in (hot or {}).items()}
        self.words = self.nodes(1)
        self.open: dict[str, tuple] = {}

    def nodes(self, n: int) -> int:
        return int(self.bases[n - 1][-1])

    def per_context(self, n: int) -> int:
        """Contexts in a shard of level n: the nodes of the level below and the start of a text."""
        return -(-(self.nodes(n - 1) + 1) // self.shards)

    def parts(self) -> tuple[str, int, list[list[int]], int, dict[int, list[int]]]:
        return self.path, self.shards, [b.tolist() for b in self.bases], self.total, {n: h.tolist() for n, h in self.hot.items()}

    def is_hot(self, n: int, context: np.ndarray) -> np.ndarray:
        hot = self.hot[n]
        return hot[np.minimum(np.searchsorted(hot, context), len(hot) - 1)] == context if len(hot) else np.zeros(len(context), bool)

    def _level1(self, k: int):
        if (key := f"1-{k}") not in self.open:
            p = f"{self.path}/{key}"
            self.open[key] = (Sequence(p), np.load(p + ".codes.npy", mmap_mode="r"), np.load(p + ".table.npy")) if os.path.exists(p + ".table.npy") else None
        return self.open[key]

    def _level(self, n: int, k: int):
        if (key := f"{n}-{k}") not in self.open:
            p = f"{self.path}/{key}"
            self.open[key] = (Sequence(p + ".contexts"), np.load(p + ".pointers.npy", mmap_mode="r"), np.load(p + ".rest.npy", mmap_mode="r"), Sequence(p + ".words"), np.load(p + ".codes.npy", mmap_mode="r")) if os.path.exists(p + ".codes.npy") else None
        return self.open[key]

    def _counts(self, n: int, k: int):
        if n == 1:
            return self._level1(k)[1:]
        if (key := f"{n}-{k}.counts") not in self.open:
            self.open[key] = (np.load(f"{self.path}/{key}.npy", mmap_mode="r"), np.load(f"{self.path}/{n}-{k}.table.npy"))
        return self.open[key]

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of distinct sorted hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(shard_of(hashes, self.shards), np.arange(self.shards + 1))
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a == b or (level := self._level1(k)) is None:
                continue
            at, found = level[0].successor(hashes[a:b])
            hit = np.flatnonzero(found)
            ids[a + hit] = self.bases[0][k] + at[hit]
            counts[a + hit] = level[2][level[1][at[hit]]]
        return ids, counts

    def _slices(self, n: int, ids: np.ndarray):
        cuts = np.searchsorted(ids, self.bases[n - 1])
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                yield k, slice(a, b), ids[a:b] - self.bases[n - 1][k]

    def counts_of(self, n: int, ids: np.ndarray) -> np.ndarray:
        """Counts of distinct sorted nodes of level n."""
        out = np.zeros(len(ids), np.int64)
        for k, part, local in self._slices(n, ids):
            codes, table = self._counts(n, k)
            out[part] = table[codes[local]]
        return out

    def log_of(self, n: int, ids: np.ndarray) -> np.ndarray:
        """log10 probability of distinct sorted nodes of level n."""
        if n == 1:
            return self.log_base(self.counts_of(1, ids))
        out = np.zeros(len(ids))
        for k, part, local in self._slices(n, ids):
            out[part] = restore(self._level(n, k)[4][local])
        return out

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.words + 1)))

    def find(self, n: int, context: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For contexts (sorted) and nodes of the level below (-1: unknown): the ids at level n (-1:
        not held), the contexts' log10 weight left to the level below, and what is held's log10 probability."""
        ids, left, value = np.full(len(context), -1, np.int64), np.zeros(len(context)), np.zeros(len(context))
        per, most = self.per_context(n), np.uint64(max(1, self.nodes(n - 1)))
        hot = self.is_hot(n, context)
        for base, rows in ((0, np.flatnonzero(~hot)), (self.shards, np.flatnonzero(hot))):
            own = context[rows]
            rows, own = rows[own >= 0], own[own >= 0]
            shard = own // per
            edge = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(own) else [0]
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                k = int(shard[a])
                if (level := self._level(n, base + k)) is None:
                    continue
                contexts, pointers, rest, words, codes = level
                at = rows[a:b]
                place, known = contexts.successor((own[a:b] - k * per).astype(np.uint64))
                at, place = at[known], place[known]
                left[at] = restore(rest[place])
                held = low[at] >= 0
                at, place = at[held], place[held]
                where, found = words.successor(place.astype(np.uint64) * most + low[at].astype(np.uint64), pointers[place].astype(np.int64), pointers[place + 1].astype(np.int64))
                at, where = at[found], where[found]
                ids[at] = self.bases[n - 1][base + k] + where
                value[at] = restore(codes[where])
        return ids, left, value


def _contexts(trie: Trie, n: int, below: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Each token's context at level n: the node of the level below that ends before it."""
    context = np.empty_like(below)
    context[1:] = below[:-1]
    context[firsts[:-1]] = trie.words if n == 2 else -1  # the start of a text
    return context


def _climb(trie: Trie, n: int, below: np.ndarray, firsts: np.ndarray, log: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Each token's node at level n, and its log probability from that of the level below."""
    key = (_contexts(trie, n, below, firsts) + 1).astype(np.uint64) << PAIR_SHIFT | (below + 1).astype(np.uint64)
    key, inverse = np.unique(key, return_inverse=True)
    ids, left, value = trie.find(n, (key >> PAIR_SHIFT).astype(np.int64) - 1, (key & np.uint64(0xFFFFFFFF)).astype(np.int64) - 1)
    node = ids[inverse]
    return node, None if log is None else np.where(node >= 0, value[inverse], log + left[inverse])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: tuple[int, int] = (5, 1), min_count: int = MIN_COUNT, discount: float = DISCOUNT, shard_bytes: int = SHARD_BYTES, batch_bytes: int = BATCH_BYTES, order: int = ORDER, hot_share: int = HOT_SHARE) -> Trie:
    """Build the levels 1 to order of all documents outside the held-out fold."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/trie-{uuid.uuid4().hex}"
    path = mounted(folder)
    texts = docs.filter(crc_bucket(id_col, held_out[0]) != held_out[1]).select(F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    shards, starts = max(12, -(-(size["b"] or 0) // shard_bytes)), size["n"]

    def words(batches):
        for batch in batches:
            column = batch.column(0)
            for lo, hi in split_rows(text_bytes(column)[1], batch_bytes):
                stream, _ = token_stream(column.slice(lo, hi - lo))
                keys, counts = np.unique(stream, return_counts=True)
                yield _cut(keys, counts, shard_of(keys, shards))

    def level1(table: pa.Table) -> pa.Table:
        k = table["shard"][0].as_py()
        keys, counts = _unpacked(table)
        os.makedirs(path, exist_ok=True)
        distinct, codes = np.unique(counts, return_inverse=True)
        span = -(-(1 << 64) // shards)
        write_sequence(f"{path}/1-{k}", keys, min(1 << 64, (k + 2) * span) - 1 if k else 2 * span)
        save_array(f"{path}/1-{k}.codes.npy", _narrow(codes, len(distinct)))
        save_array(f"{path}/1-{k}.table.npy", distinct)
        return pa.table({"shard": pa.array([k], pa.int32()), "words": pa.array([len(keys)], pa.int64()), "tokens": pa.array([int(counts.sum())], pa.int64())})

    found = {r["shard"]: r for r in texts.mapInArrow(words, PACKED).groupBy("shard").applyInArrow(level1, "shard int, words long, tokens long").collect()}
    bases = np.concatenate([[0], np.cumsum([found[k]["words"] if k in found else 0 for k in range(shards)])]).tolist()
    trie = Trie(path, shards, [bases], sum(r["tokens"] for r in found.values()))
    for n in range(2, order + 1):
        if trie.nodes(n - 1) > MOST_NODES:
            raise ValueError(f"level {n - 1} has {trie.nodes(n - 1)} nodes; an id has 32 bits")
        trie.hot[n] = _hot_contexts(spark, trie, n, starts, hot_share)
        sizes = _level_n(texts, trie, n, starts, n < order, min_count, discount, batch_bytes)
        trie.bases.append(np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(2 * shards)])]).astype(np.int64))
    return trie


def _hot_contexts(spark, trie: Trie, n: int, starts: int, hot_share: int) -> np.ndarray:
    """Contexts of level n that at least one token in hot_share follows."""
    size_of, least = trie.parts(), max(1, -(-trie.total // hot_share))

    def frequent(batches):
        trie = Trie(*size_of)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                if trie.bases[n - 2][k] < trie.bases[n - 2][k + 1]:
                    codes, table = trie._counts(n - 1, k)
                    yield pa.RecordBatch.from_arrays([pa.array(trie.bases[n - 2][k] + np.flatnonzero((table >= least)[codes]))], ["id"])

    parts = len(trie.bases[n - 2]) - 1
    found = [r["id"] for r in spark.range(0, parts, 1, min(parts, trie.shards)).mapInArrow(frequent, "id long").collect()]
    return np.array(sorted(found + [trie.words] * (n == 2 and starts >= least)), np.int64)


def _level_n(texts: DataFrame, trie: Trie, n: int, starts: int, inner: bool, min_count: int, discount: float, batch_bytes: int) -> dict[int, int]:
    """Write level n (its counts too where another follows) over the levels below; the nodes of each shard."""
    size_of, per, shards, path = trie.parts(), trie.per_context(n), trie.shards, trie.path

    def grams(batches):
        trie = Trie(*size_of)
        for batch in batches:
            column = batch.column(0)
            for lo, hi in split_rows(text_bytes(column)[1], batch_bytes):
                stream, firsts = token_stream(column.slice(lo, hi - lo))
                words, inverse = np.unique(stream, return_inverse=True)
                node = trie.lookup(words)[0][inverse]
                for m in range(2, n):
                    node, _ = _climb(trie, m, node, firsts)
                context = _contexts(trie, n, node, firsts)
                seen = (context >= 0) & (node >= 0)
                keys, counts = np.unique(context[seen].astype(np.uint64) << PAIR_SHIFT | node[seen].astype(np.uint64), return_counts=True)
                owner = (keys >> PAIR_SHIFT).astype(np.int64)
                hot = trie.is_hot(n, owner)
                mixed = (keys * np.uint64(0x9E3779B97F4A7C15)) ^ (keys >> np.uint64(29))
                yield _cut(keys, counts, np.where(hot, shards + shard_of(mixed * np.uint64(0xBF58476D1CE4E5B9), shards), owner // per))

    def build(k: int, keys: np.ndarray, counts: np.ndarray) -> int:
        """Write part k of the level: the contexts of a shard, and from `shards` on the hot ones."""
        mine = Trie(*size_of)
        below, from_ = mine.nodes(n - 1), k % shards * per
        context, low = (keys >> PAIR_SHIFT).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        owners, first, place = np.unique(context, return_index=True, return_inverse=True)
        total = np.where(owners == below, starts, mine.counts_of(n - 1, np.minimum(owners, below - 1))).astype(np.float64)
        direct = (counts - discount) / total[place]
        rest = np.clip(1 - np.bincount(place, direct, len(owners)), 1e-9, 1)
        rest_code = quantise(np.log10(rest))
        distinct, back = np.unique(low, return_inverse=True)
        p = direct + 10.0 ** (restore(rest_code)[place] + mine.log_of(n - 1, distinct)[back])  # what is held here is held below
        prefix = f"{path}/{n}-{k}"
        write_sequence(prefix + ".contexts", (owners - from_).astype(np.uint64), per)
        save_array(prefix + ".pointers.npy", np.append(first, len(keys)).astype(np.uint32))
        save_array(prefix + ".rest.npy", rest_code)
        write_sequence(prefix + ".words", place.astype(np.uint64) * np.uint64(below) + low.astype(np.uint64), len(owners) * below)
        if inner:
            distinct, codes = np.unique(counts, return_inverse=True)
            save_array(prefix + ".counts.npy", _narrow(codes, len(distinct)))
            save_array(prefix + ".table.npy", distinct)
        save_array(prefix + ".codes.npy", quantise(np.log10(p)))
        return len(keys)

    def gather(table: pa.Table) -> pa.Table:
        """A shard's part of the level, written; or the sums of some pairs of hot contexts, to be sent on."""
        k = table["shard"][0].as_py()
        keys, counts = _unpacked(table)
        often = counts >= min_count
        keys, counts = keys[often], counts[often]
        if k < shards:
            parts = [(k, build(k, keys, counts) if len(keys) else 0, None, None)]
        else:
            cut = _cut(keys, counts, (keys >> PAIR_SHIFT).astype(np.int64) // per)
            parts = list(zip(cut.column(0).to_pylist(), [None] * cut.num_rows, cut.column(1).to_pylist(), cut.column(2).to_pylist(), strict=True))
        return pa.table([pa.array([x[i] for x in parts], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["shard", "nodes", "keys", "counts"])

    def hot_part(table: pa.Table) -> pa.Table:
        k = shards + table["shard"][0].as_py()
        return pa.table({"shard": pa.array([k], pa.int32()), "nodes": pa.array([build(k, *_unpacked(table))], pa.int64())})

    sent = materialise(texts.mapInArrow(grams, PACKED).groupBy("shard").applyInArrow(gather, "shard int, nodes long, keys binary, counts binary"))
    sizes = {r["shard"]: r["nodes"] for r in sent.filter("nodes is not null").select("shard", "nodes").collect()}
    hot = sent.filter("nodes is null").select("shard", "keys", "counts").groupBy("shard").applyInArrow(hot_part, "shard int, nodes long")
    return sizes | {r["shard"]: r["nodes"] for r in hot.collect()}


def score(docs: DataFrame, trie: Trie, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row, in one map pass."""
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double"
    size_of = trie.parts()

    def run(batches):
        trie = Trie(*size_of)
        for batch in batches:
            column = batch.column(1)
            for lo, hi in split_rows(text_bytes(column)[1], batch_bytes):
                stream, firsts = token_stream(column.slice(lo, hi - lo))
                words, inverse = np.unique(stream, return_inverse=True)
                ids, counts = trie.lookup(words)
                base = trie.log_base(counts)[inverse] if trie.words else np.full(len(stream), 0.0)
                node, full = ids[inverse], base
                for n in range(2, len(trie.bases) + 1):
                    node, full = _climb(trie, n, node, firsts, full)
                sums = [np.add.reduceat(x, firsts[:-1]) for x in ((counts > 0).astype(np.int64)[inverse], base, full)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(firsts)), *map(pa.array, sums)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return frame.mapInArrow(run, schema)
