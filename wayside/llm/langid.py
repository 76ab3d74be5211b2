"""Language identification: word-first backoff.

A word known from training adds its log frequency in each language. An unseen
word falls back to its longest character n-grams (with word marks) that are
known, from max_n letters down to 1, at the mean of their log frequencies. The
sum over all words of the whole text and the log prior give the posterior. Words
are runs of letters and the marks that follow them, in lower case.

The fit uses at most sample_rows labelled rows (the smallest by a seeded hash of
doc_id) and keeps every word and n-gram of them with its count in each language.
Words and n-grams are known by 64-bit hashes of their UTF-8. Counts are summed by
Spark; the tables, cut by hash range into parts of about PART_ITEMS, are written by
tasks to a folder under spark.checkpoint.dir (a mounted path) and mapped by the
scoring tasks, so neither the driver nor a broadcast holds them. Scoring takes a
slice of texts at a time, all words of it at once.

Defined results: `und` with score 0 where the text is null or has no letter, or
nothing was learned; rows with null lang are predicted but not learned from; ids
may be null or repeat; an empty table gives an empty result; ties go to the
language first in code-point order; other columns are ignored. The input has to be
a stored table (it is read twice, and rows are told apart by their place in it).
"""

from __future__ import annotations

import os
import unicodedata
import uuid
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import crc_bucket, hash_runs, materialise, mounted, sampled, save_array, shared_dir, split_rows, text_bytes

SAMPLE_ROWS = 12000
MAX_N = 4
SMOOTH = 0.1
SLICE_BYTES = 1 << 20
PART_ITEMS = 1 << 20


@cache
def _kinds() -> np.ndarray:
    """2 for letters, 1 for marks, 0 for all other code points."""
    first = (unicodedata.category(chr(c))[0] for c in range(0x110000))
    return np.fromiter((2 if k == "L" else 1 if k == "M" else 0 for k in first), np.uint8, 0x110000)


class Words:
    """The words of some texts, in lower case: UTF-8 bytes, where each character starts, and each word's characters and text."""

    def __init__(self, texts: list[str | None]):
        low = [(t or "").lower() for t in texts]
        sizes = np.array(list(map(len, low)), np.int64)
        joined = "".join(low)
        kind = _kinds()[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        self.data = np.frombuffer(joined.encode(), np.uint8)
        self.at = np.append(np.flatnonzero((self.data & 0xC0) != 0x80), len(self.data))
        ends = np.cumsum(sizes)
        first = np.zeros(len(kind) + 1, bool)
        first[np.append(0, ends[:-1]) if len(ends) else [0]] = True
        inner = kind > 0
        before = np.concatenate([[False], inner[:-1]]) & ~first[:-1] if len(kind) else inner
        run = np.flatnonzero(inner & ~before)
        stop = np.flatnonzero(inner & ~(np.append(inner[1:], False) & ~first[1:])) + 1
        letters = np.append(np.flatnonzero(kind == 2), len(kind))
        begin = letters[np.searchsorted(letters, run)]
        held = begin < stop
        self.begin, self.end = begin[held], stop[held]
        self.text = np.searchsorted(ends, self.begin, "right")

    def hashes(self) -> np.ndarray:
        return hash_runs(self.data, self.at[self.begin], self.at[self.end] - self.at[self.begin])


class Marked:
    """Some words between `<` and `>`, for their n-grams."""

    def __init__(self, words: Words, which: np.ndarray):
        start, stop = words.at[words.begin[which]], words.at[words.end[which]]
        size = stop - start
        ends = np.cumsum(size + 2)
        self.data = np.full(int(ends[-1]) if len(ends) else 0, ord("<"), np.uint8)
        self.data[ends - 1] = ord(">")
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        self.data[np.repeat(ends - size - 1, size) + inner] = words.data[np.repeat(start, size) + inner]
        self.at = np.append(np.flatnonzero((self.data & 0xC0) != 0x80), len(self.data))
        self.chars = words.end[which] - words.begin[which] + 2
        self.first = np.cumsum(self.chars) - self.chars

    def grams(self, n: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams of these words, and the word (a place in which) of each; single marks are none."""
        skip = 1 if n == 1 else 0
        count = np.maximum(self.chars[which] - n + 1 - 2 * skip, 0)
        owner = np.repeat(np.arange(len(which)), count)
        c = self.first[which][owner] + skip + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return hash_runs(self.data, self.at[c], self.at[c + n] - self.at[c]), owner


def _count(max_n: int):
    def run(batches):
        for batch in batches:
            for lo, hi in split_rows(text_bytes(batch.column(1))[1], SLICE_BYTES):
                langs = batch.column(0).slice(lo, hi - lo).to_pylist()
                words = Words(batch.column(1).slice(lo, hi - lo).to_pylist())
                hashes, names = words.hashes(), sorted(set(langs))
                lang = np.array([names.index(x) for x in langs], np.int64)[words.text]
                for k, name in enumerate(names):
                    mine = np.flatnonzero(lang == k)
                    found, first, times = np.unique(hashes[mine], return_index=True, return_counts=True)
                    marked, every = Marked(words, mine[first]), np.arange(len(found))
                    counted = [(found, times)]
                    for n in range(1, max_n + 1):
                        grams, owner = marked.grams(n, every)
                        distinct, back = np.unique(grams, return_inverse=True)
                        counted.append((distinct, np.bincount(back, times[owner], len(distinct)).astype(np.int64)))
                    for n, (items, c) in enumerate(counted):
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(items), pa.string()), pa.array(np.full(len(items), n, np.int32)), pa.array(items.view(np.int64)), pa.array(c)], ["lang", "n", "item", "c"])

    return run


def part_of(items: np.ndarray, parts: int) -> np.ndarray:
    """Part by hash range, in hash order."""
    return ((items >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def train_langid(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_n: int = MAX_N, held_out: tuple[int, int] = (3, 1), part_items: int = PART_ITEMS) -> dict:
    """Languages, their log priors and where the tables of log frequencies lie."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(F.col("lang").isNotNull() & (crc_bucket("id", held_out[0]) != held_out[1]))
    rows = rows.join(F.broadcast(sampled(rows.select("uid", "id"), sample_rows)), "uid", "left_semi").select("lang", "text")
    counts = materialise(rows.mapInArrow(_count(max_n), "lang string, n int, item long, c long").groupBy("n", "item", "lang").agg(F.sum("c").alias("c")))
    prior = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(prior)
    totals = {(r["n"], r["lang"]): r["c"] for r in counts.groupBy("n", "lang").agg(F.sum("c").alias("c")).collect()}
    items = {r["n"]: r["items"] for r in counts.select("n", "item").distinct().groupBy("n").agg(F.count("*").alias("items")).collect()}
    levels = [-(-items.get(n, 0) // part_items) for n in range(max_n + 1)]
    path = mounted(f"{shared_dir(spark)}/langid-{uuid.uuid4().hex}")

    def deal(batches):
        for batch in batches:
            n, item = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            part = np.zeros(len(n), np.int32)
            for level in np.unique(n).tolist():
                part[n == level] = part_of(item[n == level], levels[level])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], [*batch.schema.names, "part"])

    def write(table: pa.Table) -> pa.Table:
        os.makedirs(path, exist_ok=True)
        n, part = table["n"][0].as_py(), table["part"][0].as_py()
        keys, row = np.unique(table["item"].to_numpy().view(np.uint64), return_inverse=True)
        c = np.full((len(keys), len(langs)), SMOOTH)
        c[row, np.searchsorted(langs, table["lang"].to_pylist())] += table["c"].to_numpy()
        total = np.array([totals.get((n, x), 1) for x in langs]) + SMOOTH * (items[n] + 1)
        save_array(f"{path}/{n}-{part}.keys.npy", keys)
        save_array(f"{path}/{n}-{part}.logs.npy", np.log(c / total).astype(np.float32))
        return pa.table({"n": pa.array([n], pa.int32()), "kept": pa.array([len(keys)], pa.int64())})

    dealt = counts.mapInArrow(deal, "n int, item long, lang string, c long, part int")
    kept = {r["n"]: r["kept"] for r in dealt.groupBy("n", "part").applyInArrow(write, "n int, kept long").groupBy("n").agg(F.sum("kept").alias("kept")).collect()}
    return {"langs": langs, "prior": np.log([prior[x] for x in langs]) if langs else np.zeros(0), "path": path, "levels": levels, "kept": [kept.get(n, 0) for n in range(max_n + 1)]}


class Scorer:
    """Log-likelihoods of texts from the mapped tables."""

    def __init__(self, model: dict):
        self.model, self.open = model, {}

    def rows(self, n: int, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these (sorted) are known at level n (0: words), and the known ones' log frequencies."""
        known, logs = np.zeros(len(items), bool), [np.zeros((0, len(self.model["langs"])), np.float32)]
        parts = self.model["levels"][n]
        cuts = np.searchsorted(part_of(items, parts), np.arange(parts + 1))
        for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            prefix = f"{self.model['path']}/{n}-{k}"
            if a == b or (n, k) not in self.open and not os.path.exists(prefix + ".logs.npy"):
                continue
            if (n, k) not in self.open:
                self.open[n, k] = tuple(np.load(f"{prefix}.{x}.npy", mmap_mode="r") for x in ("keys", "logs"))
            keys, values = self.open[n, k]
            at = np.minimum(np.searchsorted(keys, items[a:b]), len(keys) - 1)
            known[a:b] = keys[at] == items[a:b]
            logs.append(values[at[known[a:b]]])
        return known, np.concatenate(logs)

    def of_words(self, words: Words, which: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """One row for each of these distinct words (in hash order): its own, or its longest known n-grams' mean."""
        out = np.zeros((len(which), len(self.model["langs"])))
        known, logs = self.rows(0, hashes)
        out[known] = logs
        left = np.flatnonzero(~known)
        marked, todo = Marked(words, which[left]), np.arange(len(left))
        for n in range(len(self.model["levels"]) - 1, 0, -1):
            grams, owner = marked.grams(n, todo)
            distinct, back = np.unique(grams, return_inverse=True)
            known, logs = self.rows(n, distinct)
            hit = np.flatnonzero(known[back])
            place = (np.cumsum(known) - 1)[back[hit]]
            count = np.bincount(owner[hit], minlength=len(todo))
            found = count > 0
            for k in range(out.shape[1]):
                total = np.bincount(owner[hit], logs[place, k], len(todo))
                out[left[todo[found]], k] = total[found] / count[found]
            todo = todo[~found]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        langs = self.model["langs"]
        words = Words(texts)
        if not len(words.begin) or not langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        distinct, first, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        rows = self.of_words(words, first, distinct)
        total = np.stack([np.bincount(words.text, rows[back, k], len(texts)) for k in range(len(langs))], axis=1) + self.model["prior"]
        some = np.bincount(words.text, minlength=len(texts)) > 0
        p = np.exp(total - total.max(1, keepdims=True))
        best = total.argmax(1)
        return [langs[k] if s else "und" for k, s in zip(best.tolist(), some.tolist(), strict=True)], np.where(some, p.max(1) / p.sum(1), 0.0)


def predict_language(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row, in one map pass over the whole texts."""
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double"

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            for lo, hi in split_rows(text_bytes(batch.column(1))[1], SLICE_BYTES):
                langs, scores = scorer.predict(batch.column(1).slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return frame.mapInArrow(run, schema)
