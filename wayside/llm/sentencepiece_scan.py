"""SentencePiece encoding and decoding with a max-plus scan over giant documents.

The piece file decides the result: the ids are those of the sentencepiece library
for the whole text. A text up to chunk_chars is encoded by itself. A giant text
is split at fixed positions, whatever stands there. A chunk's tokens form paths in
a lattice whose arcs have weight 0 where two adjacent tokens can stand together
(encoding their joint text gives back just the two) and minus infinity elsewhere;
a path of weight 0 over the whole text is unique, and is the text's encoding. A
boundary state is the token that ends first at or after a cut, with its overhang.
Each chunk yields its max-plus transfer matrix between boundary states (kept
sparse: the entries of weight 0). The associative product combines them in parallel:
blocks of BLOCK_CHUNKS chunks are multiplied pairwise, a document's blocks are scanned,
and then each block finds its chunks' states on its own. Last, each chunk is backtraced
by itself between its two states.

Words (runs from one word mark up to the next) do not influence each other, as no
piece holds a mark after another character, which is checked when the file is
loaded; so only the torn words at a cut need the lattice, and the whole words
between are looked up in a bounded memory of encoded words.

Defined results: null and empty texts have no ids; a word mark (U+2581) in a text
is read as a space and decodes to one; every other text decodes to itself; ids of
rows may be null or repeat; an empty table gives an empty result. The input has to be
a stored table (rows are told apart by their place in it).
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import give_back, materialise, split_rows, text_bytes

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_CHARS = 1 << 16
BLOCK_CHUNKS = 64
CACHE_WORDS = 60_000
BATCH_BYTES = 1 << 20
MARK = "▁"
_WORDS = re.compile(f"{MARK}+[^{MARK}]*")


class Pieces:
    """A piece file: whole words by the library, torn words by the lattice."""

    def __init__(self, path: str):
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        odd = [self.lib.is_byte(i) or self.lib.is_control(i) or self.lib.is_unknown(i) or self.lib.is_unused(i) for i in range(n)]
        self.ids = {self.lib.id_to_piece(i): i for i in range(n) if not odd[i]}
        self.score = {p: self.lib.get_score(i) for p, i in self.ids.items()}
        self.byte = {int(self.lib.id_to_piece(i)[3:5], 16): i for i in range(n) if self.lib.is_byte(i)}
        self.longest = max(map(len, self.ids))
        if any(MARK in p.lstrip(MARK) for p in self.ids) or len(self.byte) != 256:
            raise ValueError("the piece file needs byte pieces and word marks only at the start of pieces")
        self.bytes = [b""] * n
        for p, i in self.ids.items():
            self.bytes[i] = p.replace(MARK, " ").encode()
        for b, i in self.byte.items():
            self.bytes[i] = bytes([b])
        self.words: dict[str, int] = {}
        self.flat, self.start, self.size, self.used = np.zeros(1024, np.int32), np.zeros(1024, np.int64), np.zeros(1024, np.int64), 0
        self.together = lru_cache(1 << 15)(self._together)
        self.alone = lru_cache(1 << 15)(self._alone)

    def forget(self) -> None:
        """Give back what was remembered of the texts, at the end of a task."""
        self.words, self.used = {}, 0
        self.flat, self.start, self.size = np.zeros(1024, np.int32), np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.together.cache_clear()
        self.alone.cache_clear()
        give_back()

    def text_of(self, ids: list[int]) -> bytes:
        """The text that ids stand for, without the mark before its first word."""
        return b"".join(map(self.bytes.__getitem__, ids))[1:]

    def merge(self, text: str) -> list[str]:
        """Byte-pair merging by score, leftmost first."""
        parts = list(text)
        while True:
            best = max(((self.score[parts[i] + parts[i + 1]], -i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in self.score), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _together(self, a: str, b: str) -> bool:
        return self.merge(a + b) == [a, b]

    def token(self, text: str) -> bool:
        return len(text) == 1 or text in self.ids and self.alone(text)

    def _alone(self, text: str) -> bool:
        return self.merge(text) == [text]

    def token_ids(self, token: str) -> list[int]:
        return [self.ids[token]] if token in self.ids else [self.byte[b] for b in token.encode()]

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of marked texts that start at a word: each word is encoded
        once, in lists, and remembered up to a bound; the texts are then gathered."""
        found = [_WORDS.findall(t) for t in texts]
        words = list(chain.from_iterable(found))
        if len(self.words) > CACHE_WORDS:
            self.words, self.used = {}, 0
        new = list(set(words).difference(self.words))
        coded = [ids if w != MARK else [self.ids[MARK]] for w, ids in zip(new, self.lib.encode([w[1:] for w in new], num_threads=1), strict=True)]
        sizes = np.array(list(map(len, coded)), np.int64)
        base, count = len(self.words), int(sizes.sum())
        self.flat = _grown(self.flat, self.used + count)
        self.flat[self.used : self.used + count] = np.fromiter(chain.from_iterable(coded), np.int32, count)
        self.start, self.size = _grown(self.start, base + len(new)), _grown(self.size, base + len(new))
        self.start[base : base + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.size[base : base + len(new)] = sizes
        self.used += count
        self.words.update(zip(new, range(base, base + len(new)), strict=True))
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        size = self.size[at]
        ends = np.cumsum(size)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[at] - ends + size, size)]
        per_text = np.cumsum([0, *map(len, found)])
        return np.concatenate([[0], ends])[per_text], ids

    def encode_words(self, text: str) -> list[int]:
        """Ids of marked text that starts at a word."""
        return self.encode_batch([text])[1].tolist()

    # -- the lattice over a torn word --

    def states(self, text: str, cut: int) -> list[tuple[int, int]]:
        """Boundary states at a cut, as (end of token, its length)."""
        if is_word_start(text, cut):
            return [(cut, 0)]
        out = []
        for end in range(cut, min(len(text), cut + self.longest - 1) + 1):
            for size in range(end - cut + (end > cut), self.longest + 1):
                if size and end - size >= 0 and end - size <= cut and (end == cut or end - size < cut) and self.token(text[end - size : end]):
                    out.append((end, size))
        return out

    def paths(self, text: str, entry: tuple[int, int], cut: int) -> tuple[dict, list[tuple[int, int]]]:
        """Tokens before each reachable end from an entry state on, and the exit states at the cut."""
        start, size = entry
        last: dict[int, int] = {start: size}
        exits = []
        if start > cut or start == cut and cut > 0:
            return last, [entry]
        stop = cut if is_word_start(text, cut) or cut >= len(text) else min(len(text), cut + self.longest - 1)
        for end in range(start + 1, stop + 1):
            for n in range(min(self.longest, end - start), 0, -1):
                at = end - n
                if at not in last or at >= cut:
                    continue
                token, before = text[at:end], text[at - last[at] : at]
                clean = last[at] == 0 or token[0] == MARK and before[-1] != MARK
                if self.token(token) and (clean or self.together(before, token)):
                    if end < cut:
                        last[end] = n
                    else:
                        exits.append((end, n))
                        last.setdefault(end, n)
                    break
        return last, [(cut, 0)] if exits and is_word_start(text, cut) else exits

    def backtrace(self, text: str, entry: tuple[int, int], exit_: tuple[int, int], cut: int) -> list[int]:
        """Ids of the tokens after the entry state up to and with the exit state."""
        if entry == exit_:
            return []
        last, _ = self.paths(text, entry, cut)
        end, size = exit_[0], exit_[1] or last[exit_[0]]
        tokens = []
        while end > entry[0]:
            tokens.append(text[end - size : end])
            end -= size
            size = last.get(end, 0)
        return list(chain.from_iterable(self.token_ids(t) for t in reversed(tokens)))


def _grown(x: np.ndarray, n: int) -> np.ndarray:
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])


def is_word_start(text: str, at: int) -> bool:
    return at == 0 or at < len(text) and text[at] == MARK and text[at - 1] != MARK


_LOADED: dict[str, Pieces] = {}


def load_pieces(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


# -- chunks: text[lo:hi] of the marked text, with `margin` characters around it --


def _anchors(text: str, lo: int, hi: int) -> tuple[int, int]:
    """First and last word start inside a chunk, or (-1, -1)."""
    first = lo if is_word_start(text, lo) else -1
    if first < 0:
        m = re.compile(f"[^{MARK}]{MARK}").search(text, lo - 1 if lo else 0, hi)
        first = m.end() - 1 if m else -1
    if first < 0:
        return -1, -1
    at = hi - 1
    while not is_word_start(text, at):
        at -= 1
    return first, at


def transfer(pieces: Pieces, text: str, lo: int, hi: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Entries of weight 0 of the chunk's max-plus matrix: entry state -> exit states."""
    first, last = _anchors(text, lo, hi)
    if first < 0:
        return {s: x for s in pieces.states(text, lo) if (x := pieces.paths(text, s, hi)[1])}
    exits = pieces.paths(text, (last, 0), hi)[1]
    if first == lo:
        return {(lo, 0): exits}
    return {s: exits for s in pieces.states(text, lo) if s[0] <= first and (s[0] == first or pieces.paths(text, s, first)[1])}


def product(a: dict, b: dict) -> dict:
    """Max-plus product of two sparse 0 / minus infinity matrices; associative."""
    return {s: out for s, mids in a.items() if (out := sorted({e for m in mids for e in b.get(m, ())}))}


def encode_chunk(pieces: Pieces, text: str, lo: int, hi: int, entry: tuple[int, int], exit_: tuple[int, int]) -> list[int]:
    first, last = _anchors(text, lo, hi)
    if first < 0 or entry[0] > first:
        return pieces.backtrace(text, entry, exit_, hi)
    head = [] if entry[0] == first else pieces.backtrace(text, entry, (first, 0), first)
    return head + pieces.encode_words(text[first:last]) + pieces.backtrace(text, (last, 0), exit_, hi)


def combined(matrices: list[dict]) -> dict:
    """The product of matrices in order, taken pairwise."""
    while len(matrices) > 1:
        matrices = [product(*matrices[i : i + 2]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
    return matrices[0]


def states_between(matrices: list[dict], entry: tuple[int, int], exit_: tuple[int, int]) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """Entry and exit state of each of these chunks or blocks: what the entry reaches, and the one chain back from the exit."""
    reach = [{entry}]
    for m in matrices:
        reach.append({e for s in reach[-1] for e in m.get(s, ())})
    out = []
    for k in range(len(matrices) - 1, -1, -1):
        (before,) = [s for s in reach[k] if exit_ in matrices[k].get(s, ())]
        out.append((before, exit_))
        exit_ = before
    return out[::-1]


# -- Spark --


def _split(chunk_chars: int, margin: int):
    def run(batches):
        for batch in batches:
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = marked(text)
                rows = []
                for k, lo in enumerate(range(0, len(text), chunk_chars)):
                    base = max(0, lo - margin)
                    rows.append((uid, k, lo - base, min(len(text), lo + chunk_chars) - base, base, len(text), text[base : lo + chunk_chars + margin]))
                    if len(rows) == 64 or lo + chunk_chars >= len(text):
                        yield pa.RecordBatch.from_pylist([dict(zip(("uid", "chunk", "lo", "hi", "base", "total", "body"), r, strict=True)) for r in rows], CHUNKS)
                        rows = []

    return run


CHUNKS = pa.schema([("uid", pa.int64()), ("chunk", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("base", pa.int64()), ("total", pa.int64()), ("body", pa.string())])
CHUNKS_DDL = "uid long, chunk int, lo long, hi long, base long, total long, body string"


def encode(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), model_path: str = MODEL_PATH, chunk_chars: int = CHUNK_CHARS, decoded: bool = False) -> DataFrame:
    """uid, kept columns and ids: one row for each row of docs. With `decoded`, also
    decoded_sha256, the SHA-256 of the text that the ids are decoded to in the same task."""
    frame = docs.select(F.monotonically_increasing_id().alias("uid"), *[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    giant = F.length("__text") >= chunk_chars
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]]

    def whole(batches):
        pieces = load_pieces(model_path)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for lo, hi in split_rows(text_bytes(column)[1], BATCH_BYTES):
                offsets, ids = pieces.encode_batch([marked(t) for t in column.slice(lo, hi - lo).to_pylist()])
                out = [*(c.slice(lo, hi - lo) for c in batch.columns[:-1]), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
                if decoded:
                    out.append(pa.array([hashlib.sha256(pieces.text_of(ids[a:b].tolist())).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[:-1], "ids", "decoded_sha256"][: len(out)])
        pieces.forget()

    def digests(batches):
        pieces = load_pieces(model_path)
        for batch in batches:
            found = [hashlib.sha256(pieces.text_of(ids.values.to_pylist())).hexdigest() for ids in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "decoded_sha256"])

    small = frame.filter(~giant).mapInArrow(whole, ", ".join([*names, "ids array<int>"] + ["decoded_sha256 string"] * decoded))
    chunks = _giant_chunks(frame.filter(giant).select("uid", F.col("__text").alias("text")), model_path, chunk_chars)
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"]))
    large = frame.filter(giant).drop("__text").join(chunks.groupBy("uid").agg(joined.alias("ids")), "uid")
    if decoded:
        large = large.mapInArrow(digests, ", ".join([*names, "ids array<int>", "decoded_sha256 string"]))
    return small.unionByName(large)


def _giant_chunks(texts: DataFrame, model_path: str, chunk_chars: int) -> DataFrame:
    """uid, chunk and ids of giant texts: split, matrices, scan, then each chunk by itself."""
    margin = load_pieces(model_path).longest + 1
    chunks = materialise(texts.mapInArrow(_split(chunk_chars, margin), CHUNKS_DDL)).repartition("uid", "chunk")

    def matrices(batches):
        pieces = load_pieces(model_path)
        for batch in batches:
            for r in batch.to_pylist():
                m = transfer(pieces, r["body"], r["lo"], r["hi"])
                at = [(s[0] + r["base"], s[1], e[0] + r["base"], e[1]) for s, out in m.items() for e in out]
                yield pa.RecordBatch.from_arrays([pa.array([r[c]] * len(at), t) for c, t in (("uid", pa.int64()), ("chunk", pa.int32()), ("total", pa.int64()))] + [pa.array([x[i] for x in at], pa.int64()) for i in range(4)], ["uid", "chunk", "total", "a", "an", "b", "bn"])

    def matrix_list(rows: pd.DataFrame, of: str) -> tuple[list[int], list[dict]]:
        found: dict[int, dict] = {}
        for k, a, an, b, bn in zip(*(rows[c].tolist() for c in (of, "a", "an", "b", "bn")), strict=True):
            found.setdefault(k, {}).setdefault((a, an), []).append((b, bn))
        places = sorted(found)
        return places, [found[k] for k in places]

    def multiply(rows: pd.DataFrame) -> pd.DataFrame:
        m = combined(matrix_list(rows, "chunk")[1])
        return pd.DataFrame([(rows["uid"].iloc[0], rows["block"].iloc[0], rows["total"].iloc[0], *s, *e) for s, out in m.items() for e in out], columns=["uid", "block", "total", "a", "an", "b", "bn"])

    def scan_blocks(rows: pd.DataFrame) -> pd.DataFrame:
        places, blocks = matrix_list(rows, "block")
        (end,) = {e for e in combined(blocks)[0, 0] if e[0] == rows["total"].iloc[0]}
        return pd.DataFrame([(rows["uid"].iloc[0], k, *s, *e) for k, (s, e) in zip(places, states_between(blocks, (0, 0), end), strict=True)], columns=["uid", "block", "a", "an", "b", "bn"])

    def inside(rows: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        places, chunks = matrix_list(rows, "chunk")
        a, an, b, bn = ends[["a", "an", "b", "bn"]].iloc[0].tolist()
        return pd.DataFrame([(rows["uid"].iloc[0], k, *s, *e) for k, (s, e) in zip(places, states_between(chunks, (a, an), (b, bn)), strict=True)], columns=["uid", "chunk", "a", "an", "b", "bn"])

    state = "a long, an long, b long, bn long"
    entries = materialise(chunks.mapInArrow(matrices, f"uid long, chunk int, total long, {state}").withColumn("block", F.expr(f"chunk div {BLOCK_CHUNKS}").cast("int")))
    blocks = entries.groupBy("uid", "block").applyInPandas(multiply, f"uid long, block int, total long, {state}")
    ends = blocks.groupBy("uid").applyInPandas(scan_blocks, f"uid long, block int, {state}")
    states = entries.groupBy("uid", "block").cogroup(ends.groupBy("uid", "block")).applyInPandas(inside, f"uid long, chunk int, {state}")

    def parts(batches):
        pieces = load_pieces(model_path)
        for batch in batches:
            rows = batch.to_pylist()
            ids = [encode_chunk(pieces, r["body"], r["lo"], r["hi"], (r["a"] - r["base"], r["an"]), (r["b"] - r["base"], r["bn"])) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], ["uid", "chunk", "ids"])
        pieces.forget()

    return chunks.drop("total").join(states, ["uid", "chunk"]).mapInArrow(parts, "uid long, chunk int, ids array<int>")


def decode(encoded: DataFrame, ids_col: str = "ids", model_path: str = MODEL_PATH) -> DataFrame:
    """The input's columns with `text` in place of the ids."""
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != ids_col)

    def run(batches):
        pieces = load_pieces(model_path)
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            lists = batch.column(at)
            rest = [i for i in range(batch.num_columns) if i != at]
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for lo, hi in split_rows(offsets - offsets[0], BATCH_BYTES // 4):
                ends = offsets[lo : hi + 1].tolist()
                out = [pieces.text_of(values[a:b].tolist()).decode() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in rest), pa.array(out, pa.string())], [*(batch.schema.names[i] for i in rest), "text"])
        give_back()

    return encoded.mapInArrow(run, names + ", text string")
