"""N-gram Jaccard join with token-combination prefixes.

A document's set holds its distinct 5-word shingles, by 64-bit hashes. Shingles are
ordered by frequency class, then hash. A linked pair shares at least k of the first
n - ceil(3n/4) + k shingles of both, for every k. If the first shared one is in a rare
class, a single rare shingle of the prefixes (k = 1) finds the pair. If not, all shared
ones are frequent, and two of them lie in the extended prefixes (k = 2): so frequent
shingles are indexed as 2-combinations. Sets of over LONG shingles, whose combinations
would be too many, are indexed by single frequent shingles, and sets between 3/4 LONG
and LONG in both ways, so a pair always has a way in common.

Frequencies are of all documents. Each task counts its shingles and sends those it holds
twice; the HEAD most frequent of these sums are known to every task (which bounds the
broadcast) and are frequent. All other shingles are dealt by hash, packed by groups of
documents, and counted exactly; those that two documents hold go back to their documents
with their class. A shingle of one document alone is the rarest: it takes its place in
the prefix, but is no key, so a document whose prefix is full of them has none.

A pair of a bucket of up to SMALL documents is taken where it meets first: at the
smallest key that is among the FIRSTS smallest of both, or everywhere if there is none.
A larger bucket gives a star from its most central document; after these links are verified
and joined, only documents outside the bucket's main component are compared with the
bucket's other components: first with the NEAREST by bitmap, and after these links are
joined too, with ever more, until a round has put none off. So a group of copies costs about one verification a document, not one
a pair, and no link between components is lost. The operator yields components, not
links: direct links inside a component are not all looked for, so it gives neither the
joined pairs nor a document's link count. Candidates are pruned by size and by parity
bitmaps in proportion to the sets (a bound that loses nothing) and verified on the texts:
shared hashes count only where their words are equal byte by byte. Documents with the
same words in the same order (SHA-256) are one in the search.

Defined results: null or empty texts have no shingles and link with nothing; texts of
under 5 words have one shingle; shingles of one document with equal 64-bit hashes count
as one; null ids never name a component unless alone; rows that repeat an id are
separate documents in the search; an empty table gives an empty result; other columns
are ignored. The input has to be a stored table (it is read several times).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import connected_components, give_back, hash_runs, lowered, materialise, mix64, pack_sorted, small_batches, split_rows, text_bytes, tidy, unpack_sorted, word_bounds, word_hashes

WORDS = 5
FREQUENT = 64
HEAD = 1 << 20
SMALL = 64
LONG = 512
FIRSTS = 4
NEAREST = 8
GROUP_BITS = 8
BATCH_BYTES = 4 << 20
SHARD_BYTES = 16 << 20
BROADCAST_ROWS = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
NONE = np.uint64((1 << 64) - 1)


def shingle_hashes(hashes: np.ndarray, firsts: np.ndarray, words: int = WORDS):
    """(row, sorted distinct shingle hashes, place of each one's first word) of each text with words."""
    n = max(0, len(hashes) - words + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(words):
        rolled = mix64(rolled * _STEP ^ hashes[k : k + n])
    for row, (a, b) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)):
        if b - a >= words:
            found, at = np.unique(rolled[a : b - words + 1], return_index=True)
            yield row, found, at + a
        elif b > a:
            h = np.array([0xA5A5A5A5A5A5A5A5 + b - a], np.uint64)
            for w in hashes[a:b]:
                h = mix64(h * _STEP ^ w)
            yield row, h, np.array([a])


def shingle_sets(column: pa.Array, words: int = WORDS):
    """(row, sorted distinct shingle hashes) of each text with words."""
    for row, found, _ in shingle_hashes(*word_hashes(*text_bytes(column)), words):
        yield row, found


def words_digest(text: str) -> bytes:
    """SHA-256 of the words in order, A-Z in lower case."""
    return hashlib.sha256(b" ".join(text.encode().lower().split())).digest()


def required(n: int) -> int:
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-3 * n // 4)


def is_head(tokens: np.ndarray, head: np.ndarray) -> np.ndarray:
    return head[np.minimum(np.searchsorted(head, tokens), len(head) - 1)] == tokens if len(head) else np.zeros(len(tokens), bool)


def prefix_keys(tokens: np.ndarray, classes: np.ndarray, n: int, long: int = LONG, frequent: int = FREQUENT) -> np.ndarray:
    """Index keys of a set of n, of which these tokens are shared with other sets: rare single
    shingles, frequent 2-combinations or, for long sets, frequent single ones. Keys are mixed
    again, as the first tokens in hash order are all small."""
    if n == 1:  # links with equal sets only
        return mix64(tokens ^ np.uint64(0x1111))
    alone, prefix = n - len(tokens), n - required(n) + 1
    rare = int((classes < frequent.bit_length() - 1).sum())
    if alone >= prefix:
        return np.zeros(0, np.uint64)
    ordered = tokens[np.lexsort((tokens, classes))]
    keys = [mix64(ordered[: min(prefix - alone, rare)])]
    if alone + rare < prefix:
        if n <= long:
            part = ordered[rare : prefix + 1 - alone]
            i, j = np.triu_indices(len(part), 1)
            keys.append(mix64(part[i] * _STEP ^ mix64(part[j])))
        if 4 * n >= 3 * long:
            keys.append(mix64(ordered[rare : prefix - alone] ^ np.uint64(0x5151515151515151)))
    return np.concatenate(keys)


SCAN = "uid long, doc_id long, n long, digest binary, bitmap binary, shard int, keys binary, counts binary"


def _scan(shards: int):
    """Per document its size, digest and bitmap; per batch the shingles that two of its documents hold."""

    def run(batches):
        for batch in batches:
            column, uid, doc_id = batch.column(2), batch.column(0), batch.column(1)
            for lo, hi in split_rows(text_bytes(column)[1], BATCH_BYTES):
                texts = column.slice(lo, hi - lo)
                digest = [words_digest(t) for t in texts.to_pylist()]
                n, maps, seen, sets = [0] * (hi - lo), [None] * (hi - lo), set(), []
                for row, s in shingle_sets(texts):
                    n[row], maps[row] = len(s), parity_bitmap(s)
                    if digest[row] not in seen:
                        seen.add(digest[row])
                        sets.append(s)
                none = lambda t: pa.nulls(hi - lo, t)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [uid.slice(lo, hi - lo), doc_id.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(maps, pa.binary()), none(pa.int32()), none(pa.binary()), none(pa.binary())], [x.split()[0] for x in SCAN.split(", ")]
                )
                keys, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                keys, counts = keys[counts > 1], counts[counts > 1]
                cuts = np.searchsorted((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), np.arange(shards + 1))
                parts = [(k, keys[a:b].tobytes(), counts[a:b].astype(np.int64).tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
                blank = [pa.nulls(len(parts), t) for t in (pa.int64(),) * 3 + (pa.binary(),) * 2]
                yield pa.RecordBatch.from_arrays([*blank, pa.array([x[0] for x in parts], pa.int32()), pa.array([x[1] for x in parts], pa.binary()), pa.array([x[2] for x in parts], pa.binary())], [x.split()[0] for x in SCAN.split(", ")])
        give_back()

    return run


def _often(least: int):
    def run(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["keys"]])
        counts = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table["counts"]])
        distinct, place = np.unique(keys, return_inverse=True)
        sums = np.bincount(place, counts, len(distinct)).astype(np.int64)
        return pa.table({"token": pa.array(distinct[sums >= least].view(np.int64)), "c": pa.array(sums[sums >= least])})

    return run


def head_tokens(counted: DataFrame, least: int = FREQUENT, most: int = HEAD) -> np.ndarray:
    """At most `most` shingles, the most frequent of those counted `least` times; sorted."""
    tokens = materialise(counted.groupBy("shard").applyInArrow(tidy(_often(least)), "token long, c long"))
    bins = sorted(((r["b"], r["count"]) for r in tokens.groupBy(F.floor(F.log2("c")).alias("b")).count().collect()), reverse=True)
    total, low = 0, None
    for b, c in bins:
        total += c
        if total > most:
            break
        low = b
    if low is None:
        return np.zeros(0, np.uint64)
    return np.sort(tokens.filter(F.floor(F.log2("c")) >= low).select("token").toPandas()["token"].to_numpy().view(np.uint64))


ENTRIES = "shard int, grp long, keys binary, rows binary"


def _entries(sent, shards: int):
    """Shingles of a batch by shard and group of documents; head shingles go through shards of their own."""

    def run(batches):
        head = sent.value
        for batch in batches:
            column, uid = batch.column(1), batch.column(0).to_numpy()
            for lo, hi in split_rows(text_bytes(column)[1], BATCH_BYTES):
                found = dict(shingle_sets(column.slice(lo, hi - lo)))
                group = uid[lo:hi] >> GROUP_BITS
                out = []
                for g in np.unique(group).tolist():
                    mine = [r for r in np.flatnonzero(group == g).tolist() if r in found]
                    if not mine:
                        continue
                    keys = np.concatenate([found[r] for r in mine])
                    docs = np.repeat((uid[lo:hi][mine] & ((1 << GROUP_BITS) - 1)).astype(np.uint8), [len(found[r]) for r in mine])
                    order = np.argsort(keys, kind="stable")
                    keys, docs = keys[order], docs[order]
                    top = is_head(keys, head)
                    if top.any():
                        out.append((shards + g % shards, g, pack_sorted(keys[top]), docs[top].tobytes()))
                    keys, docs = keys[~top], docs[~top]
                    cuts = np.searchsorted((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), np.arange(shards + 1))
                    out += [(k, g, pack_sorted(keys[a:b]), docs[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["shard", "grp", "keys", "rows"])
        give_back()

    return run


SHARED = "grp long, keys binary, rows binary, classes binary"


def _shared(shards: int):
    """Of each group of documents the shingles that two documents hold, with log2 of their number."""

    def run(table: pa.Table) -> pa.Table:
        keys = [unpack_sorted(x.as_py()) for x in table["keys"]]
        cuts = np.cumsum([0, *map(len, keys)])
        every = np.concatenate(keys)
        keys = np.split(every, cuts[1:-1])  # views: the keys are held once
        if table["shard"][0].as_py() >= shards:
            classes = np.full(len(every), 255, np.uint8)
        else:
            order = np.argsort(every, kind="stable")
            s = every[order]
            edge = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
            count = np.diff(edge)
            classes = np.empty(len(every), np.uint8)
            classes[order] = np.repeat(np.log2(count).astype(np.uint8), count)
            del order, s, edge
        out = []
        for g, k, rows, a, b in zip(table["grp"].to_pylist(), keys, table["rows"].to_pylist(), cuts[:-1], cuts[1:], strict=True):
            if (mask := classes[a:b] > 0).any():
                out.append((g, k[mask].tobytes(), np.frombuffer(rows, np.uint8)[mask].tobytes(), classes[a:b][mask].tobytes()))
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary(), pa.binary()))], [x.split()[0] for x in SHARED.split(", ")])

    return run


INDEX = "shard int, keys binary, docs binary, uids binary, sizes binary, firsts binary"


def _index(shards: int, long: int, frequent: int):
    """Packed index entries of a group of documents; each document brings its FIRSTS smallest keys."""

    def run(shared: pa.Table, sizes: pa.Table) -> pa.Table:
        out = []
        if shared.num_rows and sizes.num_rows:
            tokens, rows, classes = (np.concatenate([np.frombuffer(x.as_py(), t) for x in shared[c]]) for c, t in (("keys", np.uint64), ("rows", np.uint8), ("classes", np.uint8)))
            order = np.argsort(rows, kind="stable")
            tokens, rows, classes = tokens[order], rows[order], classes[order]
            base = shared["grp"][0].as_py() << GROUP_BITS
            size_of = dict(zip((sizes["uid"].to_numpy() - base).tolist(), sizes["n"].to_pylist(), strict=True))
            keys, docs, uid, size, firsts = [], [], [], [], []
            docs_at, first = np.unique(rows, return_index=True)
            for d, a, b in zip(docs_at.tolist(), first.tolist(), [*first[1:].tolist(), len(rows)], strict=True):
                k = prefix_keys(tokens[a:b], classes[a:b], size_of[d], long, frequent)
                if len(k):
                    docs.append(np.full(len(k), len(uid), np.int32))
                    keys.append(k)
                    uid.append(base + d)
                    size.append(size_of[d])
                    low = np.partition(k, FIRSTS - 1)[:FIRSTS] if len(k) >= FIRSTS else k
                    firsts.append(np.concatenate([np.sort(low), np.full(FIRSTS - len(low), NONE)]))
            if keys:
                keys, docs = np.concatenate(keys), np.concatenate(docs)
                uid, size, firsts = np.array(uid, np.int64), np.array(size, np.int32), np.array(firsts, np.uint64)
                shard = ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                found, at = np.unique(shard[order], return_index=True)
                for k, o in zip(found.tolist(), np.split(order, at[1:]), strict=True):
                    mine, local = np.unique(docs[o], return_inverse=True)
                    out.append((k, keys[o].tobytes(), local.astype(np.int32).tobytes(), uid[mine].tobytes(), size[mine].tobytes(), firsts[mine].tobytes()))
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), *(pa.binary(),) * 5))], [x.split()[0] for x in INDEX.split(", ")])

    return run


def _sizes_fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 4 * np.minimum(a, b) >= 3 * np.maximum(a, b)


def _meets_here(firsts: np.ndarray, x: np.ndarray, y: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether pairs of documents that share a key are to be taken at it."""
    out = np.empty(len(x), bool)
    for at in range(0, len(x), 1 << 18):
        s = slice(at, at + (1 << 18))
        both = (firsts[x[s]][:, :, None] == firsts[y[s]][:, None, :]).any(2)
        least = np.where(both, firsts[x[s]], NONE).min(1)
        out[s] = (least == NONE) | (least == key[s])
    return out


def _most_central(docs: np.ndarray, per: np.ndarray, start: np.ndarray, length: np.ndarray, small: int) -> np.ndarray:
    """For each entry of the large buckets the bucket's document that is in the most and largest of them."""
    big = per > small
    members = docs[big]
    weight = np.bincount(members, per[big], minlength=int(docs.max()) + 1 if len(docs) else 1)
    first = np.cumsum(length) - length
    if not len(first):
        return members
    bucket = np.repeat(np.arange(len(length)), length)
    order = np.lexsort((members, -weight[members], bucket))
    return np.repeat(members[order[first]], length)


BUCKETS = "shard int, a long, b long, uids binary, lengths binary, members binary"


def _buckets(small: int):
    """Candidate pairs of a shard that meet here first, and one row with the member lists of its large buckets."""

    def run(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["keys"]])
        firsts = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table["firsts"]]).reshape(-1, FIRSTS)
        uids, sizes, docs, base = [], [], [], 0
        for d, u, z in zip(table["docs"], table["uids"], table["sizes"], strict=True):
            docs.append(np.frombuffer(d.as_py(), np.int32).astype(np.int64) + base)
            uids.append(np.frombuffer(u.as_py(), np.int64))
            sizes.append(np.frombuffer(z.as_py(), np.int32))
            base += len(uids[-1])
        docs, uids, sizes = np.concatenate(docs), np.concatenate(uids), np.concatenate(sizes).astype(np.int64)
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        length = np.diff(edge)
        keep = np.repeat(length > 1, length)
        keys, docs, length = keys[keep], docs[keep], length[length > 1]
        start = np.cumsum(length) - length
        per = np.repeat(length, length)
        codes = []
        for d in range(1, small):
            i = np.flatnonzero((per[:-d] <= small) & (keys[d:] == keys[:-d])) if d < len(keys) else np.zeros(0, np.int64)
            x, y = docs[i], docs[i + d]
            ok = np.flatnonzero(_sizes_fit(sizes[x], sizes[y]))
            ok = ok[_meets_here(firsts, x[ok], y[ok], keys[i[ok]])]
            codes.append(np.unique(x[ok] * base + y[ok]))
        large = np.flatnonzero(length > small)
        members = docs[per > small]
        leader = _most_central(docs, per, start[large], length[large], small)
        ok = np.flatnonzero(_sizes_fit(sizes[leader], sizes[members]) & (leader != members))
        ok = ok[_meets_here(firsts, leader[ok], members[ok], keys[per > small][ok])]
        codes.append(leader[ok] * base + members[ok])
        pairs = np.unique(np.concatenate(codes))
        x, y = uids[pairs // max(1, base)], uids[pairs % max(1, base)]
        used, local = np.unique(members, return_inverse=True)
        rows = len(pairs) + bool(len(large))
        shard = table["shard"][0].as_py()
        lists = [None] * len(pairs)
        extra = lambda v: pa.array(lists + ([v] if len(large) else []), pa.binary())
        return pa.table(
            {
                "shard": pa.array([shard] * rows, pa.int32()),
                "a": pa.array(np.append(np.minimum(x, y), [0] * bool(len(large))).astype(np.int64), mask=np.arange(rows) >= len(pairs)),
                "b": pa.array(np.append(np.maximum(x, y), [0] * bool(len(large))).astype(np.int64), mask=np.arange(rows) >= len(pairs)),
                "uids": extra(uids[used].tobytes()),
                "lengths": extra(length[large].astype(np.int32).tobytes()),
                "members": extra(local.astype(np.int32).tobytes()),
            }
        )

    return run


def parity_bitmap(tokens: np.ndarray) -> bytes:
    """Bit i: whether an odd number of hashes are i modulo the bitmap's bits, a power of two of at least four times the set."""
    bits = max(64, 1 << (4 * len(tokens) - 1).bit_length())
    return np.packbits(np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def _folded(x: np.ndarray, words: int) -> np.ndarray:
    """The parity bitmaps of the same sets at fewer bits."""
    while x.shape[1] > words:
        x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
    return x


def _apart(xa: np.ndarray, xb: np.ndarray) -> np.ndarray:
    """The distance of parity bitmaps: the symmetric difference of the sets is at least as large."""
    words = min(xa.shape[1], xb.shape[1])
    return np.bitwise_count(_folded(xa, words) ^ _folded(xb, words)).sum(-1, dtype=np.int64)


def _may_link(na, nb, xa: np.ndarray, xb: np.ndarray) -> np.ndarray:
    """Whether the parity bitmaps allow 3/4."""
    return 7 * _apart(xa, xb) <= na + nb


def _matrix(maps: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(maps), np.uint64).reshape(len(maps), -1)


NEAR = "d long, others binary, left long"


def _between(nearest: int):
    """Candidates of a shard's large buckets between different components, packed by document:
    the nearest by bitmap, and how many more there are."""
    return lambda lists, labels: _near_candidates(lists, labels, nearest)


def _near_candidates(lists: pa.Table, labels: pa.Table, nearest: int) -> pa.Table:
    if not lists.num_rows:
        return pa.table({"d": pa.array([], pa.int64()), "others": pa.array([], pa.binary()), "left": pa.array([], pa.int64())})
    uid = labels["uid"].to_numpy()
    order = np.argsort(uid)
    uid = uid[order]
    size, label = (labels[c].to_numpy()[order] for c in ("n", "label"))
    maps = labels["bitmap"].to_pylist()
    maps = [maps[i] for i in order]
    width = np.array([len(x) for x in maps])
    rows_of = {w: np.flatnonzero(width == w) for w in np.unique(width).tolist()}
    matrix = {w: _matrix([maps[i] for i in rows]) for w, rows in rows_of.items()}
    slot = np.empty(len(uid), np.int64)
    for rows in rows_of.values():
        slot[rows] = np.arange(len(rows))
    at = np.searchsorted(uid, np.frombuffer(lists["uids"][0].as_py(), np.int64))
    length = np.frombuffer(lists["lengths"][0].as_py(), np.int32).astype(np.int64)
    members = at[np.frombuffer(lists["members"][0].as_py(), np.int32)]
    start = np.cumsum(length) - length
    own = label[members]
    mixed = np.flatnonzero(np.minimum.reduceat(own, start) != np.maximum.reduceat(own, start))
    partners: dict[int, list[tuple[int, int]]] = {}
    for k in mixed.tolist():
        s, e = int(start[k]), int(start[k] + length[k])
        values, counts = np.unique(own[s:e], return_counts=True)
        for d in members[s:e][own[s:e] != values[counts.argmax()]].tolist():
            partners.setdefault(d, []).append((s, e))
    out = []
    for d, ranges in partners.items():
        mask = np.zeros(len(uid), bool)
        for s, e in ranges:
            mask[members[s:e]] = True
        c = np.flatnonzero(mask & (label != label[d]))
        c = c[_sizes_fit(size[c], size[d])]
        found, apart = [np.zeros(0, np.int64)], [np.zeros(0)]
        for w in np.unique(width[c]).tolist():
            e = c[width[c] == w]
            gap = _apart(matrix[w][slot[e]], _matrix([maps[d]]))
            ok = 7 * gap <= size[e] + size[d]
            found.append(e[ok])
            apart.append(gap[ok] / (size[e][ok] + size[d]))
        others = uid[np.concatenate(found)]
        if len(others):
            near = np.lexsort((others, np.concatenate(apart)))[:nearest]
            out.append((int(uid[d]), others[near].tobytes(), len(others) - len(near)))
    return pa.table({"d": pa.array([x[0] for x in out], pa.int64()), "others": pa.array([x[1] for x in out], pa.binary()), "left": pa.array([x[2] for x in out], pa.int64())})


def _distinct_pairs(table: pa.Table) -> pa.Table:
    """The pairs of some documents' packed candidates, each once."""
    d = np.repeat(table["d"].to_numpy(), [len(x.as_py()) // 8 for x in table["others"]])
    other = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table["others"]])
    pairs = np.unique(np.stack([np.minimum(d, other), np.maximum(d, other)], axis=1), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0].copy()), "b": pa.array(pairs[:, 1].copy())})


def _prune(batches):
    for batch in batches:
        na, nb = (batch.column(i).to_numpy() for i in (2, 3))
        xa, xb = (batch.column(i).to_pylist() for i in (4, 5))
        keep = _sizes_fit(na, nb)
        shape = np.array([len(x) << 32 | len(y) for x, y in zip(xa, xb, strict=True)], np.int64)
        for k in np.unique(shape):
            at = np.flatnonzero(shape == k)
            keep[at] &= _may_link(na[at], nb[at], _matrix([xa[i] for i in at]), _matrix([xb[i] for i in at]))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])


class Words:
    """The words and shingles of a slice of texts."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        self.data = lowered(data)
        self.starts, ends, firsts = word_bounds(data, offsets)
        self.lengths = ends - self.starts
        self.sets = {row: (found, at) for row, found, at in shingle_hashes(hash_runs(self.data, self.starts, self.lengths), firsts)}
        self.count = np.minimum(np.diff(firsts), WORDS)


def same_words(x: Words, i: np.ndarray, y: Words, j: np.ndarray) -> np.ndarray:
    """Whether words i of x equal words j of y, byte by byte."""
    same = x.lengths[i] == y.lengths[j]
    at = np.flatnonzero(same)
    size = x.lengths[i[at]]
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    equal = x.data[np.repeat(x.starts[i[at]], size) + inner] == y.data[np.repeat(y.starts[j[at]], size) + inner]
    if len(at):
        same[at] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
    return same


def linked(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Whether the texts of each pair share three quarters of their shingles: equal hashes count where their words are equal."""
    x, y = Words(left), Words(right)
    owner, i, j, union = [], [], [], np.ones(len(left), np.int64)
    for row in x.sets.keys() & y.sets.keys():
        (a, at_a), (b, at_b) = x.sets[row], y.sets[row]
        _, k, m = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        union[row] = len(a) + len(b)
        if x.count[row] == y.count[row] and 7 * len(k) >= 3 * union[row]:
            owner.append(np.full(len(k), row))
            i.append(at_a[k])
            j.append(at_b[m])
    if not owner:
        return np.zeros(len(left), bool)
    owner, i, j = np.concatenate(owner), np.concatenate(i), np.concatenate(j)
    count = x.count[owner]
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    pairs, back = np.unique((np.repeat(i, count) + inner) * np.int64(len(y.starts)) + np.repeat(j, count) + inner, return_inverse=True)
    equal = same_words(x, pairs // len(y.starts), y, pairs % len(y.starts))[back]
    common = np.bincount(owner[np.logical_and.reduceat(equal, np.cumsum(count) - count)], minlength=len(left))
    return 100 * common >= 75 * (union - common)


def _verify(batches):
    for batch in batches:
        x, y = batch.column(2), batch.column(3)
        size = np.cumsum([0, *(np.diff(text_bytes(x)[1]) + np.diff(text_bytes(y)[1])).tolist()])
        keep = [linked(x.slice(lo, hi - lo), y.slice(lo, hi - lo)) for lo, hi in split_rows(size, BATCH_BYTES)]
        mask = pa.array(np.concatenate([np.zeros(0, bool), *keep]), pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts reach the threshold; stored. The second of a pair,
    which is in few pairs, brings its text along to the first."""
    wanted = materialise(pairs.select(F.col("a").alias("uid")).union(pairs.select("b")).distinct())
    few = wanted.count() <= BROADCAST_ROWS
    held = texts.join(F.broadcast(wanted) if few else wanted, "uid", "left_semi")
    both = pairs.join(held.toDF("b", "y"), "b").join(held.toDF("a", "x"), "a").select("a", "b", "x", "y")
    return materialise(both.mapInArrow(_verify, "a long, b long"))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, head_size: int = HEAD, small: int = SMALL, long: int = LONG) -> DataFrame:
    """uid, doc_id, n_shingles, component_id and stays (one row of each group: the smallest id, then the first row): one row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    shards = max(12, -(-size // SHARD_BYTES))
    scan = materialise(texts.mapInArrow(_scan(shards), SCAN))
    info = scan.filter("uid is not null").select("uid", "doc_id", "n", "digest", "bitmap")
    head = spark.sparkContext.broadcast(head_tokens(scan.filter("shard is not null").select("shard", "keys", "counts"), frequent, head_size))
    same = info.filter("n > 0").groupBy("digest").agg(F.min("uid").alias("low"), F.count("*").alias("c")).filter("c > 1").drop("c")
    copies = materialise(info.filter("n > 0").join(same, "digest").filter("uid <> low").select(F.col("low").alias("a"), F.col("uid").alias("b")))
    plain, later = texts.select("uid", "text"), copies.select(F.col("b").alias("uid"))
    single = plain.join(F.broadcast(later) if later.count() <= BROADCAST_ROWS else later, "uid", "left_anti")
    group = F.shiftright("uid", GROUP_BITS).alias("grp")
    shared = single.mapInArrow(_entries(head, shards), ENTRIES).groupBy("shard").applyInArrow(tidy(_shared(shards)), SHARED)
    index = shared.groupBy("grp").cogroup(info.select(group, "uid", "n").groupBy("grp")).applyInArrow(_index(shards, long, frequent), INDEX)
    found = materialise(index.groupBy("shard").applyInArrow(tidy(_buckets(small)), BUCKETS))
    signs = info.select("uid", "n", "bitmap")
    pairs = found.filter("a is not null").select("a", "b").distinct().join(signs.toDF("a", "na", "xa"), "a").join(signs.toDF("b", "nb", "xb"), "b").select("a", "b", "na", "nb", "xa", "xb")
    pairs = materialise(pairs.mapInArrow(_prune, "a long, b long"))
    links = _verified(pairs, plain)
    links = links.union(copies)
    labels = materialise(connected_components(links).toDF("uid", "label"))
    lists = found.filter("members is not null").select("shard", "uids", "lengths", "members")

    def present(batches):
        for batch in batches:
            for shard, uids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                u = np.unique(np.frombuffer(uids, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(u), pa.int32()), pa.array(u)], ["shard", "uid"])

    held = materialise(lists.select("shard", "uids").mapInArrow(present, "shard int, uid long").join(signs, "uid"))
    nearest = NEAREST
    while True:
        where = held.join(labels, "uid", "left").withColumn("label", F.coalesce("label", "uid"))
        more = materialise(lists.groupBy("shard").cogroup(where.groupBy("shard")).applyInArrow(_between(nearest), NEAR))
        state = more.agg(F.count("*").alias("n"), F.sum("left").alias("left")).first()
        if state["n"]:
            pairs = more.groupBy("d").applyInArrow(_distinct_pairs, "a long, b long").distinct()
            new = _verified(materialise(pairs), plain)
            if not new.isEmpty():
                links = links.union(new)
                labels = materialise(connected_components(links).toDF("uid", "label"))
        if not state["left"]:  # nothing was put off, so every candidate has been verified
            break
        nearest *= nearest
    named = info.select("uid", "doc_id", F.col("n").alias("n_shingles")).join(labels, "uid", "left")
    named = materialise(named)
    lowest = named.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid"))["uid"].alias("stay"))
    few = labels.count() <= BROADCAST_ROWS
    named = named.join(F.broadcast(lowest) if few else lowest, "label", "left")
    alone = F.col("label").isNull()
    return named.select("uid", "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), (alone | (F.col("uid") == F.col("stay"))).alias("stays"))
