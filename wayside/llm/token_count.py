"""Token counts: byte-pair merging of batched words in arrays, all sequences in step.

Texts are cut at ASCII white space, which no token crosses. The distinct pieces of a
slice are normalised (NFC, lower case by code point) and split by the vocabulary's
pattern; the distinct pre-tokens lie one after another in one array of symbols. Each
round finds every sequence's pair of lowest rank and merges it in all sequences at
once, where it occurs from left to right, until no pair has a rank; what is left is
counted. A rule whose product has a rule of lower rank than itself is applied once a
sequence and round, so the order is that of merging one pair at a time. Sequences of
over LONG symbols would need many rounds over their whole length; they are merged in
step too, but rank by rank over linked arrays, where a round costs what it merges.

Scale: one pass over the texts without a shuffle; a task's memory is bounded by an
Arrow batch and one text. The vocabulary (bounded by its file) is sent to each task.

Defined results: null counts as empty, 0 bytes and 0 tokens; the vocabulary's special
strings inside a text are one token each; ids may be null or repeat (a row each); a text
that is one long word is counted whole; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import give_back, text_bytes, word_bounds

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
SLICE_BYTES = 8 << 20
LONG = 64
MEMO = 1 << 16
MEMO_BYTES = 64
NONE = np.int32((1 << 31) - 1)


class Vocabulary:
    """Merge rules as sorted arrays, the symbols of single bytes, the split pattern and the special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, ids = spec["model"], spec["model"]["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or not suffix or steps != ["NFC", "Replace", "Lowercase"] or any(t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: not a byte-pair vocabulary with word ends over NFC lower-cased text")
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        signs = byte_signs()
        self.inner = np.array([ids[c] for c in signs], np.int64)
        self.final = np.array([ids[c + suffix] for c in signs], np.int64)
        rules = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(model["merges"])}
        left, right = (np.array([k[i] for k in rules], np.int64) for i in (0, 1))
        rank, new = (np.array([v[i] for v in rules.values()], np.int64) for i in (0, 1))
        order = np.argsort(left << 32 | right)
        self.pairs, self.ranks = (left << 32 | right)[order], rank[order].astype(np.int32)
        self.product = np.zeros(len(model["merges"]), np.int64)
        self.product[rank] = new
        lowest = np.full(max(ids.values()) + 1, NONE, np.int64)  # of the rules that a symbol is in
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        self.safe = np.ones(len(model["merges"]), bool)
        self.safe[rank] = lowest[new] > rank

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of pairs of symbols; NONE where there is no rule."""
        wanted = a << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.ranks[at], NONE)


def byte_signs() -> list[str]:
    """The sign that stands for each byte: itself where it can be printed, else one from 256 on in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def _leftmost(at: np.ndarray, following: np.ndarray, sequence: np.ndarray, safe: np.ndarray) -> np.ndarray:
    """Which of the places (in order) are merged now: every second one of a run that overlaps, and only a sequence's first for rules that are not safe."""
    starts = np.flatnonzero(np.concatenate([[True], following[:-1] != at[1:]]))
    step = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    first = np.concatenate([[True], sequence[1:] != sequence[:-1]])
    return (step % 2 == 0) & (safe | first)


def merge_short(symbols: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Symbols left of each sequence (lengths of at least 1): a round merges the lowest pair of every sequence."""
    left = lengths.copy()
    sequence = np.repeat(np.arange(len(lengths)), lengths)

    def ranks(at: np.ndarray) -> np.ndarray:
        b = np.minimum(at + 1, len(symbols) - 1)
        return np.where((sequence[b] == sequence[at]) & (b > at), vocabulary.rank_of(symbols[at], symbols[b]), NONE)

    rank = ranks(np.arange(len(symbols)))
    while len(symbols):
        starts = np.flatnonzero(np.concatenate([[True], sequence[1:] != sequence[:-1]]))
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbols))))
        going = best < NONE
        if not going.all():  # sequences without a pair are done
            symbols, sequence, rank, best = symbols[going], sequence[going], rank[going], best[going]
            if not len(symbols):
                break
        at = np.flatnonzero(rank == best)
        at = at[_leftmost(at, at + 1, sequence[at], vocabulary.safe[rank[at]])]
        left -= np.bincount(sequence[at], minlength=len(left))
        symbols[at] = vocabulary.product[rank[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, sequence, rank = symbols[keep], sequence[keep], rank[keep]
        at = at - np.arange(len(at))
        touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
        rank[touched] = ranks(touched)
    return left


def merge_long(symbols: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The same for long sequences: rank by rank over linked arrays, where a round costs what it merges."""
    n = len(symbols)
    left = lengths.copy()
    sequence = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.cumsum(lengths)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1] = n
    before[ends - lengths] = -1
    rank = np.full(n + 1, NONE, np.int32)
    inner = np.flatnonzero(after < n)
    rank[inner] = vocabulary.rank_of(symbols[inner], symbols[after[inner]])
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def wait(at: np.ndarray) -> None:
        at = at[rank[at] < NONE]
        at = at[np.argsort(rank[at], kind="stable")]
        found, first = np.unique(rank[at], return_index=True)
        for r, places in zip(found.tolist(), np.split(at, first[1:]), strict=False):
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(heap, r)
            waiting[r].append(places)

    wait(inner)
    while heap:
        r = heapq.heappop(heap)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[rank[at] == r]
        if not len(at):
            continue
        chosen = _leftmost(at, after[at], sequence[at], np.full(len(at), vocabulary.safe[r]))
        later, at = at[~chosen], at[chosen]
        left -= np.bincount(sequence[at], minlength=len(left))
        gone = after[at]
        symbols[at] = vocabulary.product[r]
        after[at] = after[gone]
        rank[gone] = NONE
        inside = after[at] < n
        before[after[at[inside]]] = at[inside]
        touched = np.unique(np.concatenate([at, before[at][before[at] >= 0]]))
        follower = after[touched]
        ok = follower < n
        rank[touched] = NONE
        rank[touched[ok]] = vocabulary.rank_of(symbols[touched[ok]], symbols[follower[ok]])
        wait(np.concatenate([touched, later]))
    return left


def count_sequences(pretokens: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """Symbols that survive merging, for each pre-token."""
    if not pretokens:
        return np.zeros(0, np.int64)
    lengths = np.array([len(p) for p in pretokens], np.int64)
    data = np.frombuffer(b"".join(pretokens), np.uint8)
    symbols = vocabulary.inner[data]
    ends = np.cumsum(lengths)
    symbols[ends - 1] = vocabulary.final[data[ends - 1]]
    out = np.zeros(len(lengths), np.int64)
    long = lengths > LONG
    inside = np.repeat(long, lengths)
    for chosen, mask, merge in ((~long, ~inside, merge_short), (long, inside, merge_long)):
        if chosen.any():
            out[chosen] = merge(symbols[mask], lengths[chosen], vocabulary)
    return out


class Counter:
    """Token counts of pieces between white space; short pieces are remembered, up to MEMO of them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(vocabulary.pattern)
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special)))
        self.known: dict[bytes, int] = {}

    def pretokens(self, piece: bytes) -> tuple[int, list[str]]:
        """Special strings of a piece, and its pre-tokens."""
        parts = self.special.split(piece.decode("utf-8", "replace"))
        found: list[str] = []
        for part in parts:
            text = unicodedata.normalize("NFC", part)
            # lower() looks at the surroundings of one letter only
            found += self.split.findall(text.replace("Σ", "σ").lower())
        return len(parts) - 1, found

    def count(self, pieces: list[bytes]) -> np.ndarray:
        out = np.zeros(len(pieces), np.int64)
        names: dict[str, int] = {}
        owner, name, fresh = [], [], []
        for i, piece in enumerate(pieces):
            n = self.known.get(piece)
            if n is not None:
                out[i] = n
                continue
            out[i], found = self.pretokens(piece)
            fresh.append(i)
            owner += [i] * len(found)
            name += [names.setdefault(p, len(names)) for p in found]
        sizes = count_sequences([p.encode() for p in names], self.vocabulary)
        out += np.bincount(np.array(owner, np.int64), sizes[np.array(name, np.int64)] if name else None, len(pieces)).astype(np.int64)
        if len(self.known) > MEMO:
            self.known.clear()
        self.known.update((pieces[i], int(out[i])) for i in fresh if len(pieces[i]) <= MEMO_BYTES)
        return out


def count_batch(column: pa.Array, counter: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of each text of a column, in slices cut between words."""
    data, offsets = text_bytes(column)
    starts, ends, firsts = word_bounds(data, offsets)
    row = np.repeat(np.arange(len(column)), np.diff(firsts))
    tokens, lo = np.zeros(len(column), np.int64), 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + SLICE_BYTES)))
        lengths = ends[lo:hi] - starts[lo:hi]
        edges = np.concatenate([[0], np.cumsum(lengths)])
        inner = np.zeros(ends[hi - 1] - starts[lo] + 1, np.int8)
        inner[starts[lo:hi] - starts[lo]] = 1
        inner[ends[lo:hi] - starts[lo]] -= 1
        packed = data[starts[lo] : ends[hi - 1]][np.cumsum(inner[:-1], dtype=np.int8).view(bool)]
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(edges), pa.py_buffer(packed)]).dictionary_encode()
        counts = counter.count(pieces.dictionary.to_pylist())
        np.add.at(tokens, row[lo:hi], counts[pieces.indices.to_numpy()])
        lo = hi
    return np.diff(offsets), tokens


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of docs. path: the vocabulary's file on the driver."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path or public_tokenizers.path(VOCABULARY)))

    def run(batches):
        counter = Counter(vocabulary.value)
        for batch in batches:
            n_bytes, n_tokens = count_batch(batch.column(1), counter)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
