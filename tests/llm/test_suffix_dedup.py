import hashlib
import random

import numpy as np
import pytest

import wayside.llm.suffix_dedup as operator
from wayside.llm.suffix_dedup import deep_shallow, suffix_dedup


def brute(rows, width=50):
    first = {}
    key = lambda d: (d is None, d or 0)
    raws = [(d, (t or "").encode()) for d, t in rows]
    for d, raw in raws:
        for i in range(len(raw) - width + 1):
            s = raw[i : i + width]
            if s not in first or key(d) < first[s]:
                first[s] = key(d)
    out = []
    for d, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            if first[raw[i : i + width]] < key(d):
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (8, 12, 20, 60)]
    texts = [None, "", "short", "x" * 49, "x" * 50, "x" * 120, "ab" * 70, "x" * 50 + "y", passages[3], passages[3], passages[3] + "!"]
    for _ in range(70):
        parts = [" ".join(word() for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            parts.insert(rng.randint(0, len(parts)), p[a : len(p) - rng.randint(0, len(p) // 3)])
        texts.append("".join(parts))
    texts += [rng.choice(texts[10:]) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, (7, texts[20]), (None, texts[21]), (None, texts[22]), (20, texts[20])]


@pytest.mark.parametrize("seed, few", [(1, 1 << 20), (2, 0)])
def test_against_brute_force(spark, seed, few, tmp_path, monkeypatch):
    monkeypatch.setattr(operator, "BROADCAST_ROWS", few)
    rows = corpus(seed)
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, uid string").repartition(3).write.parquet(f"{tmp_path}/d")
    got = suffix_dedup(spark.read.parquet(f"{tmp_path}/d"), shard_bytes=1500).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)


def test_deep_shallow_order():
    rng = np.random.default_rng(8)
    flat = np.concatenate([rng.choice(np.array([97, 98], np.uint8), 3000), np.tile(np.frombuffer(b"abcab", np.uint8), 200), np.zeros(8, np.uint8)])
    starts = rng.integers(0, 3950, 2500)
    order, cls = deep_shallow(flat, starts)
    text = [flat[s : s + 50].tobytes() for s in starts[order]]
    assert text == sorted(text)
    assert [a == b for a, b in zip(text, text[1:])] == (cls[1:] == cls[:-1]).tolist()


def test_empty(spark):
    assert suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
