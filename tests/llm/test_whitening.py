import numpy as np
import pytest

from wayside.llm import whitening as W
from wayside.llm.queries import op12_whitening

NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def dense(rows, wanted=4):
    """{(position of row, component): (n, deviation, |whitened|, explained)} by a dense eigensolver."""
    kept = [(i, [int(np.floor(256 * float(c))) for c in e]) for i, e in rows if e and all(c is not None and np.isfinite(c) for c in e)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit, float) - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    out = []
    for i, x in kept:
        white = (np.array(x) - np.array([s / n for s in sums])) @ vectors / np.sqrt(np.where(values > 1e-9, values, 1))
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        out += [(i, c + 1, n, deviation, abs(white[c]), values[c] / np.square(centred).sum() * n) for c in range(len(values)) if values[c] > 1e-9]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, e, 5, "y") for i, e in rows], "vec_id long, embedding array<float>, n int, x string")


def same(out, wanted):
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(wanted)
    order = lambda r: (str(r[0]), r[1], r[3], round(abs(r[4]), 6))
    for got, want in zip(sorted(rows, key=order), sorted(wanted, key=order), strict=True):
        assert got[:4] == want[:4]
        assert abs(got[4]) == pytest.approx(want[4], rel=1e-9, abs=1e-9)
        assert got[5] == pytest.approx(want[5], rel=1e-9)
        assert got[6] < 1e-10


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    return [(i, np.float32(rng.normal(size=d) * np.linspace(1, 0.3, d)).tolist()) for i in range(n)]


@pytest.mark.parametrize(("n", "d"), [(300, 64), (40, 6), (30, 3), (200, 100)])
def test_against_a_dense_solver(spark, n, d):
    rows = vectors(n, d, n)
    same(W.whiten(table(spark, rows)), dense(rows))


def test_repeats_and_rows_left_out(spark):
    rows = vectors(50, 8, 1)
    every = rows + [(100 + i, rows[0][1]) for i in range(300)] + [(3, rows[4][1]), (None, rows[5][1])]
    bad = [(1, None), (2, []), (3, [None] * 8), (4, [float("nan")] * 8), (5, [float("inf")] + [0.0] * 7)]
    short = [(6, [0.5] * 5), (7, [0.25] * 5)]
    same(W.whiten(table(spark, every + bad + short)), dense(every))


def test_flat_directions_and_empty_tables(spark):
    plane = [(i, [float(a), float(b), 0.5, 0.5]) for i, (a, b) in enumerate([(0, 0), (1, 0), (0, 2), (1, 2), (3, 1)])]
    out = W.whiten(table(spark, plane))
    assert {r.component for r in out.collect()} == {1, 2}
    same(out, dense(plane))
    assert W.whiten(table(spark, [(i, [0.5] * 8) for i in range(9)])).count() == 0
    assert W.whiten(table(spark, [(1, None)])).count() == 0
    assert W.whiten(table(spark, [])).columns == NAMES


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(4_000_000 * (i == 3)), float(i)]) for i in range(5)]
    assert [r.deviation is None for r in W.whiten(table(spark, rows)).filter("component = 1").orderBy("vec_id").collect()] == [d >= 1 << 63 for i, c, n, d, *_ in dense(rows) if c == 1]
    with pytest.raises(Exception, match="is beyond"):
        W.whiten(table(spark, [(1, [1e9, 2.0]), (2, [0.0, 0.0])]))


def test_restarts_and_equal_eigenvalues():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(200, 200)))[0]
    spectrum = np.concatenate([[5, 5, 5, 4.999999], np.linspace(4.9, 0, 196)])
    v = (q * spectrum) @ q.T
    values, found, norms = W.jacobi_davidson(lambda u: v @ u, 200, 4, most_basis=24)
    assert np.abs(values - spectrum[:4]).max() < 1e-12 and (norms <= W.tolerance(200) * 5).all()
    assert np.abs(found.T @ found - np.eye(4)).max() < 1e-12


def test_minres_solves_the_systems():
    rng = np.random.default_rng(4)
    a = [rng.normal(size=(9, 9)) for _ in range(3)]
    a = [m + m.T for m in a]
    rhs = rng.normal(size=(9, 3))
    x = W.minres(lambda t: np.stack([m @ t[:, j] for j, m in enumerate(a)], axis=1), rhs, 9)
    assert np.abs(np.stack([m @ x[:, j] for j, m in enumerate(a)], axis=1) - rhs).max() < 1e-6


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    out = op12_whitening(spark, folder)
    assert out.dtypes == list(zip(NAMES, ["bigint", "int", "bigint", "bigint", "double", "double", "double"], strict=True))
    same(out, dense([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]))
