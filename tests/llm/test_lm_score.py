import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from wayside.llm.elias_fano import Sequence, write_sequence
from wayside.llm.lm_score import score, train


def test_sequence(tmp_path):
    rng = np.random.default_rng(1)
    for n, universe in ((0, 10), (1, 1 << 63), (1000, 1 << 62), (5000, 6000), (300, 40), (200_000, 1 << 44)):
        values = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
        write_sequence(f"{tmp_path}/x{n}", values, universe)
        s = Sequence(f"{tmp_path}/x{n}")
        ask = np.concatenate([values[:3000], rng.integers(0, universe, 500, dtype=np.uint64), np.array([0, universe - 1], np.uint64)])
        at, equal = s.successor(ask)
        assert (equal == np.isin(ask, values)).all()
        assert (at[equal] == np.searchsorted(values, ask[equal])).all()
        if n == 1000:
            lo = np.searchsorted(values, ask)
            assert s.successor(ask, lo + 1, np.full(len(ask), n))[1].sum() == 0


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def test_against_brute_force(spark):
    texts = ["the cat sat on the mat", "The cat\tsat", None, "", "the dog sat on the cat", "unknown zebra the cat", "x " * 400, "Éa éa the"] * 9
    rows = [(i if i % 11 else None, t, 1.0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    trie = train(docs, batch_bytes=300, shard_bytes=200)
    out = {(r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 9), round(r.score, 6)) for r in score(docs, trie, batch_bytes=500).collect()}
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _, _ in rows]
    uni, pair, starts = Counter(), Counter(), 0
    for (_, t, _), h in zip(rows, held, strict=True):
        if not h:
            w = [*words(t), 0]
            uni.update(w)
            pair.update(zip([1, *w], w, strict=False))
            starts += 1
    n, v = sum(uni.values()), len(uni)
    base = lambda w: math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1)))
    code = lambda x: min(255, max(0, round(-x * 255 / 12))) * -12 / 255
    total = lambda c: starts if c == 1 else uni[c]
    kept = {k: c for k, c in pair.items() if c >= 2}
    rest = {}
    for (c, _), m in kept.items():
        rest[c] = rest.get(c, 1) - (m - 0.75) / total(c)
    rest = {c: code(math.log10(min(1, max(1e-9, x)))) for c, x in rest.items()}
    want = set()
    for i, t, _ in rows:
        w = [*words(t), 0]
        s = 0.0
        for c, x in zip([1, *w], w, strict=False):
            if (c, x) in kept:
                s += code(math.log10((kept[c, x] - 0.75) / total(c) + 10 ** (rest[c] + base(x))))
            else:
                s += rest.get(c, 0) + base(x)
        want.add((i, len(w), sum(uni[x] > 0 for x in w), round(sum(map(base, w)), 9), round(s, 6)))
    assert trie.total == n and trie.words == v
    assert out == want


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert score(docs, train(docs)).count() == 0


@pytest.mark.parametrize("hot_share", [1 << 16, 12, 1])
def test_three_levels_with_all_that_was_seen(spark, hot_share):
    texts = ["the cat sat on the mat", "the cat sat down", "The dog sat on the cat", None, "a cat ran", "zebra sat on the mat", "on the mat sat a dog", "x y x y x"] * 3
    texts += ["seen once only here", "the cat seen once", "q r s t"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in score(docs, train(docs, batch_bytes=300, shard_bytes=200, min_count=1, order=3, hot_share=hot_share), batch_bytes=500).collect()}
    grams, starts, n = [Counter(), Counter(), Counter()], 0, 0
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 5 != 1:
            w = [1, *words(t), 0]
            starts, n = starts + 1, n + len(w) - 1
            for k in (1, 2, 3):
                grams[k - 1].update(zip(*(w[j:] for j in range(k)), strict=False))
    grams[0].pop((1,))
    v = len(grams[0])
    code = lambda x: min(255, max(0, round(-x * 255 / 12))) * -12 / 255
    total = lambda c: starts if c == (1,) else grams[len(c) - 1][c]

    def log(g):
        if len(g) == 1:
            return math.log10((grams[0][g] + 0.5) / (n + 0.5 * (v + 1)))
        c, low = g[:-1], log(g[1:])
        follow = [m for h, m in grams[len(g) - 1].items() if h[:-1] == c]
        if not follow:
            return low
        rest = code(math.log10(min(1, max(1e-9, 1 - sum((m - 0.75) / total(c) for m in follow)))))
        m = grams[len(g) - 1][g]
        return code(math.log10((m - 0.75) / total(c) + 10 ** (rest + low))) if m else rest + low

    assert sum(m == 1 for m in grams[1].values()) > 3
    for i, t in enumerate(texts):
        w = [1, *words(t), 0]
        assert abs(out[i].score - sum(log(tuple(w[max(0, j - 2) : j + 1])) for j in range(1, len(w)))) < 1e-6


def test_scores_do_not_depend_on_neighbours(spark):
    seen = [f"w{i % 40} w{i % 7} w{i % 11} the w{i % 3}" for i in range(120)]
    fresh = [" ".join(f"new{i}x{k}" for k in range(30)) + " the w1" for i in range(60)]
    texts = [t for pair in zip(seen, fresh * 2, strict=True) for t in pair]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    trie = train(docs.filter("length(text) < 40"), batch_bytes=300, shard_bytes=200, min_count=1, order=3)
    ask = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = {r.doc_id: r.score for r in score(ask.repartition(1), trie, batch_bytes=1 << 20).collect()}
    for parts, size in ((1, 1), (7, 1), (3, 400), (40, 1 << 20)):
        got = {r.doc_id: r.score for r in score(ask.repartition(parts), trie, batch_bytes=size).collect()}
        assert max(abs(got[i] - want[i]) for i in want) < 1e-9
