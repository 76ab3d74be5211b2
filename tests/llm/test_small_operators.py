"""Exact dedup, quality, mixing and language identification on small tables with awkward rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from wayside.llm.common import sampled
from wayside.llm.exact_dedup import exact_dedup
from wayside.llm.langid import Scorer, Words, predict_language, train_langid
from wayside.llm.mixing import mix_stream, mix_taken
from wayside.llm.quality import score_quality, train_quality

EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


def awkward():
    texts = [None, "", "", "a", "a", "b" * 5000, "b" * 5000, "b" * 5001, "é" * 3000, "é" * 3000, " ", "c" * 8, "c" * 16, "c" * 16]
    rows = [(i, t, f"k{i}") for i, t in enumerate(texts)]
    return [*rows, (3, "a", None), (None, "a", ""), (None, "n", ""), (None, "n", "")]


@pytest.mark.parametrize("route", [F.xxhash64, lambda c: F.length(c).cast("long") % 3])
def test_exact_dedup(spark, route, tmp_path):
    rows = awkward()
    spark.createDataFrame(rows, "doc_id long, text string, name string").repartition(3).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    got = exact_dedup(docs, block_bytes=8, route=route).collect()
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[t or ""].append(d)
    want = []
    for d, t, _ in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        want.append((d, keep, len(g), d is not None and d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in got)
    assert sum(r.stays for r in got) == len(groups) and all(r.kept or r.doc_id is None for r in got if r.stays)


def mixed():
    rng = random.Random(2)
    rows = []
    for i in range(300):
        source = rng.choice(["a", "a", "a", "a", "é", "B", None, "tiny"]) if i else "tiny"
        if source == "tiny" and i:
            source = "a"
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 40, 700])), source, i))
    return [*rows, (5, "one two", "B", 0), (None, "x y", "B", 0), (400, None, "z", 0)]


def test_mixing(spark):
    rows = mixed()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(3)
    got = mix_taken(docs, block_words=16, least_slots=1).collect()
    again = mix_taken(docs.repartition(5), block_words=16, least_slots=1).collect()
    assert sorted((r.doc_id or -1, r.size, r.taken) for r in got) == sorted((r.doc_id or -1, r.size, r.taken) for r in again)
    sizes = defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    held = {s: None for s in order}
    while True:
        rate = (sum(sizes.values()) - sum(3 * sizes[s] for s in order if held[s])) / sum(weight[s] for s in order if not held[s])
        new = [s for s in order if not held[s] and 3 * sizes[s] < rate * weight[s]]
        if not new:
            break
        held.update(dict.fromkeys(new, True))
    target = {s: float(3 * sizes[s]) if held[s] else rate * weight[s] for s in order}
    by_source = defaultdict(int)
    source_of = {(d, len((t or "").split())): s for d, t, s, _ in rows}
    for r in got:
        s = source_of[r.doc_id, r.size]
        assert r.target == target[s] and r.source_size == sizes[s] and 0 <= r.taken <= 3 * r.size
        by_source[s] += r.taken
    total, w = sum(target.values()), 16
    upto, slots = np.cumsum([round(target[s]) for s in order]), defaultdict(list)
    for i in range(-(-int(upto[-1]) // w)):
        point = i * 2654435769 % (1 << 32)
        k = next(k for k, u in enumerate(upto) if point < math.floor(float(u) / float(upto[-1]) * (1 << 32)))
        slots[order[k]].append(i)
    assert all(by_source[s] == min(w * len(slots[s]), 3 * sizes[s]) and abs(by_source[s] - target[s]) <= 4 * w for s in order)
    _, stream = mix_stream(docs, block_words=w, least_slots=1)
    rows = stream.collect()
    assert all(slots[order[r.sid]][r.r] == r.slot for r in rows)
    assert {r.slot: r.sid for r in rows}.keys() <= set(range(sum(map(len, slots.values()))))
    words = defaultdict(int)
    for r in rows:
        words[r.slot] += r.words
    assert max(words.values()) <= w
    for s in order:  # every prefix of the mix has its share of each source
        have = np.searchsorted(slots[s], np.arange(0, 2 * len(rows), 37))
        upper = np.minimum(np.arange(0, 2 * len(rows), 37), -(-int(upto[-1]) // w))
        assert np.abs(have - upper * target[s] / total).max() < 4
    first = {}
    for r in rows:
        first[r.uid] = min(first.get(r.uid, r.slot), r.slot)
    assert sorted(first.values()) == sorted(r.first_slot for r in got if r.taken)


def test_quality(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choice(["river", "stone", "the", "of", "light", "grows"]) for _ in range(50)) for _ in range(80)]
    bad = ["### $$$ " * rng.randint(5, 60) for _ in range(60)]
    texts = good + bad + [None, "", "x"]
    docs = spark.createDataFrame([(i, t, i % 3, 0.0) for i, t in enumerate(texts)], "doc_id long, text string, quality int, quality_score2 double")
    labels = spark.createDataFrame([(i, int(i < 80)) for i in range(140)] + [(3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    scored = {r.doc_id: r.quality_score for r in score_quality(docs, train_quality(docs, labels), keep=["doc_id", "quality"]).collect()}
    assert len(scored) == len(texts) and all(0 <= v <= 1 for v in scored.values())
    assert sum((scored[i] >= 0.5) == (i < 80) for i in range(140)) >= 138
    blank = train_quality(docs, labels.filter("quality = 1"))
    assert {r.quality_score for r in score_quality(docs, blank, keep=["doc_id"]).collect()} == {0.5}
    none = spark.createDataFrame([], EMPTY)
    assert score_quality(none, train_quality(none, labels.limit(0))).count() == 0


def test_language(spark):
    rng = random.Random(4)
    words = {"en": ["the", "house", "stands", "with", "green"], "de": ["der", "Straße", "über", "nicht", "größer"]}
    rows = []
    for i in range(120):
        lang = ["en", "de"][i % 2]
        rows.append((i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(1, 30))), lang, "x"))
    rows += [(200, None, "en", ""), (201, "123 !!", "de", ""), (202, "großes housing", None, ""), (None, "the green", None, ""), (203, "zzz", None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict_language(docs, train_langid(docs)).collect()}
    assert all(got[i][0] == ["en", "de"][i % 2] for i in range(120))
    assert got[200] == got[201] == ("und", 0.0) and got[None][0] == "en" and all(0 <= s <= 1 for _, s in got.values())
    none = spark.createDataFrame([], EMPTY)
    assert predict_language(none, train_langid(none)).count() == 0
    assert predict_language(docs, train_langid(none)).filter("lang_pred <> 'und'").count() == 0


WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def plain_language(rows, ask, max_n=4):
    """The operator's rule word by word, on strings."""
    learn = [(lang, t) for i, t, lang in rows if lang is not None and zlib.crc32(b"" if i is None else str(i).encode()) % 3 != 1]
    langs = sorted({x for x, _ in learn})
    grams = lambda w, n: [g for k in range(len(w) + 3 - n) if (g := f"<{w}>"[k : k + n]) not in ("<", ">")]
    count = [{x: Counter() for x in langs} for _ in range(max_n + 1)]
    for lang, t in learn:
        for w in WORD.findall((t or "").lower()):
            count[0][lang][w] += 1
            for n in range(1, max_n + 1):
                count[n][lang].update(grams(w, n))
    items = [set().union(*c.values()) for c in count]
    log = lambda n, x: np.array([math.log((count[n][g][x] + 0.1) / ((sum(count[n][g].values()) or 1) + 0.1 * (len(items[n]) + 1))) for g in langs])
    prior = np.log([sum(x == lang for x, _ in learn) for lang in langs])

    def word(w):
        if w in items[0]:
            return log(0, w)
        for n in range(max_n, 0, -1):
            if found := [g for g in grams(w, n) if g in items[n]]:
                return np.mean([log(n, g) for g in found], axis=0)
        return np.zeros(len(langs))

    out = {}
    for i, t, _ in ask:
        seen = WORD.findall((t or "").lower())
        total = prior + sum(map(word, seen), np.zeros(len(langs)))
        p = np.exp(total - total.max())
        out[i] = (langs[int(total.argmax())], float(p.max() / p.sum())) if seen else ("und", 0.0)
    return out


def test_language_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    letters = {"en": "abcdeth", "de": "abcdeßüh", "ru": "абвгд", "hi": "क ि ख ा".split()}
    words = {x: ["".join(rng.choice(c) for _ in range(rng.choice([1, 2, 3, 5, 30]))) for _ in range(40)] for x, c in letters.items()}
    rows = []
    for i in range(150):
        lang = rng.choice(list(letters))
        text = " ".join(rng.choice(words[lang if rng.random() < 0.8 else "en"]) + rng.choice(["", "", "1", "-x", "Q"]) for _ in range(rng.choice([1, 2, 5, 60])))
        rows.append((i, text, lang if rng.random() < 0.9 else None))
    rows += [(500, None, "en"), (501, "", None), (502, "12 -- ̈", "de"), (503, "̈́a ́b", None), (504, "the " * 30000, None), (505, "İSTANBUL ΣΑΣ", None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, uid string").repartition(3)
    docs.write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    want = plain_language(rows, rows)
    for size in (1 << 20, 7):
        got = {r.doc_id: (r.lang_pred, r.score) for r in predict_language(docs, train_langid(docs, part_items=size)).collect()}
        assert got.keys() == want.keys()
        assert all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-4 for i in want)
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    other = docs.withColumn("lang", F.when(F.col("doc_id").isin(held), F.lit("zz")).otherwise(F.col("lang")))
    assert {r.doc_id: r.lang_pred for r in predict_language(docs, train_langid(other)).collect()} == {i: x[0] for i, x in want.items()}


def test_language_keeps_every_counted_word(spark):
    ids = [i for i in range(9) if zlib.crc32(str(i).encode()) % 3 != 1]
    letters = "abcdefghij"
    many = ["".join(letters[int(x)] for x in f"{k:05d}") for k in range(41000)]
    rows = [(ids[0], " ".join([*many, *many, "zulu"]), "en"), (ids[1], "zulu casa", "es")]
    model = train_langid(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    words = Words(["zulu"])
    known, logs = Scorer(model).rows(0, words.hashes())
    assert model["kept"][0] == 41002 and model["langs"] == ["en", "es"] and known.all()
    assert np.allclose(logs[0], np.log([1.1 / (82001 + 0.1 * 41003), 1.1 / (2 + 0.1 * 41003)]), atol=1e-5)


def plain_features(text):
    raw = (text or "").encode()
    if not raw:
        return [0.0] * 137
    words, lines = raw.split(), raw.split(b"\n")
    m, upper, high = max(1, len(words)), sum(65 <= b <= 90 for b in raw), sum(b > 127 for b in raw)
    letters = upper + high + sum(97 <= b <= 122 for b in raw)
    shares = [raw.count(bytes([b])) / len(raw) for b in range(128)] + [high / len(raw)]
    return [*shares, math.log1p(len(raw)) / 10, upper / max(1, letters), len(set(words)) / m, max(Counter(words).values(), default=0) / m, sum(map(len, words)) / m / 10, len(set(lines)) / len(lines), sum(u == v for u, v in zip(words, words[1:], strict=False)) / m, letters / len(raw)]


def plain_quality(rows, labels):
    """Features one by one, and Bradley-Terry by plain gradient steps on the same pairs."""
    x = np.array([plain_features(rows[i]) for i, _ in labels])
    y = np.array([q for _, q in labels])
    mean, spread = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / spread, -8, 8)
    rng = np.random.default_rng(7)
    d = z[rng.choice(np.flatnonzero(y == 1), 40000)] - z[rng.choice(np.flatnonzero(y == 0), 40000)]
    w = np.zeros(z.shape[1])
    rate = 1.0 / np.linalg.eigvalsh(d.T @ d / len(d) / 4 + 1e-3 * np.eye(len(w))).max()
    velocity = np.zeros_like(w)
    for _ in range(1000):
        ahead = w + 0.97 * velocity
        velocity = 0.97 * velocity + rate * ((d / (1 + np.exp(d @ ahead))[:, None]).mean(0) - 1e-3 * ahead)
        w = w + velocity
    threshold = np.quantile(z @ w, (y == 0).mean(), method="midpoint")
    return {i: 1 / (1 + math.exp(-float(np.clip((np.array(plain_features(t)) - mean) / spread, -8, 8) @ w - threshold))) for i, t in rows.items()}


def test_quality_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    word = lambda good: rng.choice(["river", "Stone", "the", "light"] if good else ["CLICK", "now!!", "the", "$$$"])
    rows = {i: "\n".join(" ".join(word(i % 2 == 0 or rng.random() < 0.3) for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 6))) for i in range(90)}
    rows |= {900: None, 901: "", 902: "é" * 40, 903: "word " * 50000}
    labels = [(i, int(i % 2 == 0)) for i in range(80)]
    learned = [(i, q) for i, q in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    spark.createDataFrame([(i, t, 0) for i, t in rows.items()], "doc_id long, text string, quality int").repartition(1).sortWithinPartitions("doc_id").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    frame = lambda x: spark.createDataFrame(x, "doc_id long, quality int")
    score = lambda x: {r.doc_id: r.quality_score for r in score_quality(docs, train_quality(docs, x), keep=["doc_id"]).collect()}
    got, want = score(frame(labels)), plain_quality(rows, learned)
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 0.02
    assert score(frame([(i, q if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - q) for i, q in labels] + labels[:9])) == got  # held-out and repeated labels change nothing
    assert score(frame([(i, 1 - q) for i, q in labels])) != got


def test_samples_are_bounded_and_repeat(spark):
    ids = spark.range(5000).select(F.col("id").alias("uid"), (F.col("id") % 700).alias("id")).repartition(7)
    once, again = (sorted(r.uid for r in sampled(x, 300).collect()) for x in (ids, ids.coalesce(2)))
    assert once == again and 200 <= len(once) <= 300
    assert sampled(ids.limit(10), 300).count() == 10


def test_empty(spark):
    none = spark.createDataFrame([], EMPTY)
    assert exact_dedup(none).count() == 0 and mix_taken(none).count() == 0


def test_connected_components(spark):
    from wayside.llm.common import connected_components

    rng = random.Random(5)
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(200, 240)] + [(250, 7)]
    other = [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    edges = path + hub + other + [(1, 2), (1, 2), (2, 1), (3, 3)]
    low = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in low:
        for a, b in edges:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in found) == sorted(low.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
