import hashlib

import duckdb
import numpy as np
import pytest

from wayside.llm import va_cluster as V
from wayside.llm.queries import ORACLE, op11_va_cluster


def plain(rows, k=16, rounds=3):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) by comparing every vector with every centroid."""
    kept = [(i, [int(np.floor(64 * float(c))) for c in e]) for i, e in rows if e is not None and len(e) == 64 and all(c is not None and np.isfinite(c) for c in e)]
    order = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)
    centroids = [x for _, x in order[:k]]
    if not kept:
        return []
    x = np.array([v for _, v in kept], np.int64)

    def nearest():
        far = np.array([((x - np.array(c)) ** 2).sum(1) for c in centroids])
        return far.argmin(0), far.min(0)

    for _ in range(rounds):
        cluster, _ = nearest()
        for j in range(len(centroids)):
            if (cluster == j).any():
                centroids[j] = [int(s) // int((cluster == j).sum()) for s in x[cluster == j].sum(0)]
    cluster, distance = nearest()
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, int(c), int(d), int(distance[cluster == c].sum()), int(distance.sum()), digest[c]) for (i, _), c, d in zip(kept, cluster, distance, strict=True)]


def got(out):
    return sorted((tuple(r)[:6] for r in out.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, e, "x", 7) for i, e in rows], "vec_id long, embedding array<float>, cluster string, x int")


def vectors(n, seed, spread=0.12):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(9, 64)) * 0.1
    return [(i, np.float32(middles[i % 9] + rng.normal(size=64) * spread).tolist()) for i in range(n)]


@pytest.mark.parametrize("bits", [1, 2, 4, 6])
def test_exact_whatever_the_cells(spark, bits):
    rows = vectors(700, 3)
    out = V.cluster_vectors(table(spark, rows), bits=bits, sample_rows=200)
    assert got(out) == sorted(plain(rows), key=str)
    shares = out.selectExpr("avg(int(fetched))").first()[0]
    assert shares > 0.9 if bits == 1 else shares < 0.7 if bits == 6 else True


def test_left_out_ties_repeats_nulls(spark):
    rows = vectors(60, 5)
    copies = [(1000 + i, rows[0][1]) for i in range(200)] + [(7, rows[1][1])] * 3 + [(None, rows[2][1]), (None, rows[3][1])]
    bad = [(1, None), (2, []), (3, [0.5] * 63), (4, [0.5] * 65), (5, [0.5] * 63 + [None]), (6, [0.5] * 63 + [float("nan")]), (7, [0.5] * 63 + [float("-inf")])]
    outlier = [(8, [300.0] + [0.0] * 63), (9, [-0.0] * 64)]
    every = rows + copies + bad + outlier
    assert got(V.cluster_vectors(table(spark, every))) == sorted(plain(every), key=str)
    few = rows[:3] + [(3, rows[0][1])]
    assert got(V.cluster_vectors(table(spark, few))) == sorted(plain(few), key=str)
    same = [(i, [0.25] * 64) for i in range(40)]
    assert got(V.cluster_vectors(table(spark, same))) == sorted(plain(same), key=str)
    assert V.cluster_vectors(table(spark, bad)).count() == 0
    assert V.cluster_vectors(table(spark, [])).count() == 0


def test_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="would not fit"):
        V.cluster_vectors(table(spark, [(1, [2.0**21] * 64)])).collect()


def test_intervals_hold_the_distances():
    rng = np.random.default_rng(1)
    x = rng.integers(-90, 90, (300, 64))
    cells = V.Cells(x[:40], x.min(0), x.max(0), 3)
    packed = cells.encode(x)
    assert packed.shape == (300, 24)
    code = cells.decode(packed)
    d = np.arange(64)
    assert (cells.low[d, code] <= x).all() and (x <= cells.high[d, code]).all()
    centroids = rng.integers(-90, 90, (5, 64))
    total = sum(t[code[:, i]] for i, t in enumerate(cells.tables(centroids)))
    exact = ((x[:, None] - centroids) ** 2).sum(2)
    assert (total[:, :5] <= exact).all() and (exact <= total[:, 5:]).all()


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    out = op11_va_cluster(spark, folder)
    assert out.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")]
    con = duckdb.connect()
    con.execute(f"create view embeddings as from '{folder}/embeddings.parquet'")
    wanted = con.execute(ORACLE["op11_va_cluster"]).fetchall()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert got(out) == sorted(wanted, key=str) == sorted(plain(rows), key=str)
