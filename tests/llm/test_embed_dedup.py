import math

import numpy as np
import pytest

from wayside.llm.embed_dedup import candidate_pairs, embedding_dedup, fit


def brute(rows, least=0.95):
    good = [i for i, (v, x, *_) in enumerate(rows) if v is not None and x and all(c is not None and math.isfinite(c) for c in x) and any(x)]
    links = {i: set() for i in good}
    for i in good:
        for j in good:
            if i < j and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1]), np.array(rows[j][1])
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least or rows[i][1] == rows[j][1]:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i, (v, *_) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((v, len(links.get(i, ())), low, v is not None and v == low))
    return sorted(map(repr, out))


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 64))
    rows = []
    for k in range(400):
        c = base[k % 30]
        x = c + rng.normal(size=64) * (0.02 if k % 30 < 12 else 3.0) * np.linalg.norm(c) / 8
        rows.append((k, [float(np.float32(v)) for v in x], "label"))
    rows += [(900 + i, rows[5][1], None) for i in range(4)] + [(5, rows[5][1], None)]
    rows += [(901, None, ""), (902, [0.0] * 64, ""), (903, [float("nan")] * 64, ""), (904, [None, 1.0], ""), (None, rows[5][1], ""), (905, [1.0, 0.5], ""), (906, [2.0, 1.0], ""), (907, [], ""), (908, [float("inf")] + [1.0] * 63, "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")
    for tile in (2048, 7):
        got = sorted(repr(tuple(r)) for r in embedding_dedup(frame, tile=tile).collect())
        assert got == brute(rows)


def test_recall_near_the_threshold(spark):
    """Pairs at cosine 0.95 to 0.97, against the cosines of all pairs."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    c = rng.uniform(0.95, 0.97, (len(x), 1))
    vectors = np.concatenate([x, c * x + np.sqrt(1 - c * c) * z])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, 0)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>")
    found = sum(r[1] for r in embedding_dedup(frame).collect())
    true = int((cosine >= 0.95).sum())
    print(f"links found: {found} of {true}")
    assert true >= 2900 and 0.9 * true <= found <= true


def test_empty(spark):
    assert embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def planted(n, d, seed):
    """Unit vectors, each with a partner at cosine 0.95 to 0.97."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    c = rng.uniform(0.95, 0.97, (n, 1))
    return np.concatenate([x, c * x + np.sqrt(1 - c * c) * z])


@pytest.mark.parametrize("d", [8, 32, 48, 64, 384])
def test_recall_and_candidates_at_any_dimension(spark, d):
    vectors = planted(600, d, d)
    cosine = vectors @ vectors.T
    np.fill_diagonal(cosine, 0)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "uid long, embedding array<double>")
    found = sum(r[1] for r in embedding_dedup(frame, "uid").collect())
    true = int((cosine >= 0.95).sum())
    pairs = candidate_pairs(frame, fit(frame), len(vectors)).count()
    print(f"{d} dimensions: links {found} of {true}, candidates {pairs} of {len(vectors) * (len(vectors) - 1) // 2}")
    assert 0.9 * true <= found <= true
    # a few per cent of all pairs at eight dimensions, where vectors are near each other anyway
    assert pairs <= (0.2 if d == 8 else 0.02) * len(vectors) ** 2 / 2 + 2 * true


def test_other_lengths_have_full_codes(spark):
    vectors = planted(150, 12, 3)
    rows = [(i, v) for i, v in enumerate(planted(200, 64, 1).tolist())] + [(1000 + i, v) for i, v in enumerate(vectors.tolist())]
    frame = spark.createDataFrame(rows, "uid long, embedding array<double>")
    model = fit(frame)
    assert model["dim"] == 64
    assert candidate_pairs(frame.filter("uid >= 1000"), model, 300).count() < 300 * 299 / 2 * 0.2
    got = {r[0]: r[1] for r in embedding_dedup(frame, "uid").collect()}
    assert sum(n > 0 for i, n in got.items() if i >= 1000) >= 270
