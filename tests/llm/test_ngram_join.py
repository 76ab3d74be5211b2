import random
import re

import numpy as np
import pyarrow as pa
import pytest

import wayside.llm.ngram_join as m
from wayside.llm.ngram_join import ngram_join


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(map(repr, ((d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))))


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(3))
    passage = [word() for _ in range(12)]
    texts = [None, "", " ", "one", "one", "one two", "Two one", "a b c d", "a B c\td", "a b c d e", "A b c d e"]
    for group in range(8):
        base = [word() for _ in range(rng.choice([8, 30, 60, 150]))]
        for _ in range(rng.choice([2, 5, 40])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 18))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy + (passage if rng.random() < 0.4 else [])))
    for _ in range(60):
        texts.append(" ".join([word() for _ in range(rng.randint(3, 20))] + passage * rng.randint(1, 2)))
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, texts[40]), (None, texts[41]), (None, "lonely words that nobody else has here")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"frequent": 4, "small": 4}, {"frequent": 2, "small": 3, "long": 40}, {"frequent": 8, "small": 16, "head_size": 0}])
def test_against_brute_force(spark, options):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, uid string, n int").repartition(3).coalesce(2)
    path = __import__("tempfile").mkdtemp() + "/d"
    docs.write.parquet(path)
    got = ngram_join(spark.read.parquet(path), **options).drop("uid", "stays").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)


def test_words_decide(monkeypatch, spark, tmp_path):
    """Long words of two letters whose polynomial sums agree, equal words in other cases, and a hash that collides."""
    parity = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    swapped = parity.translate(str.maketrans("ab", "ba"))
    one = " ".join(f"t{i}" for i in range(40))
    rows = [(0, parity), (1, swapped), (2, f"{parity} {one}"), (3, f"{swapped} {one}"), (4, "a a a a a"), (5, "A a a a a a a"), (6, "a a a a"), *((k, one.upper() + f" k{k}") for k in range(7, 200))]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/d")
    got = ngram_join(spark.read.parquet(f"{tmp_path}/d"), small=8, frequent=8).drop("uid", "stays").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)
    left, right = pa.array(["a b c d e f", "x y", "p q r s t u", ""]), pa.array(["A b c d e f", "x z", "p q r s t v", ""])
    monkeypatch.setattr(m, "hash_runs", lambda data, starts, lengths: np.ones(len(starts), np.uint64))
    assert m.linked(left, right).tolist() == [True, False, True, False]  # one hash: the first shingles are compared, and are equal in rows 0 and 2
    monkeypatch.undo()
    assert m.linked(left, right).tolist() == [True, False, False, False]


def test_empty(spark):
    assert ngram_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
