"""The rounds of the nearest join: what they compare and that they settle rightly."""

import math
import random

import pytest

from wayside.operators import nearest as N


def gap(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    n = dx * dx + dy * dy
    t = max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / n)) if n else 0.0
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


def tables(spark, segs, points):
    s = spark.createDataFrame(segs, "sid int, kind string, ax double, ay double, bx double, b_y double")
    return s, spark.createDataFrame(points, "pid int, kind string, x double, y double")


def test_uniform_lines_and_piled_points_meet_few_pairs(spark, monkeypatch):
    """4000 lines in a few roots, below the size from which the quadtree cuts, and 50 copies of every point:
    before, each copy met all lines of nine roots, some 440 a point."""
    rng = random.Random(4)
    segs = [(j, "k", x, y, x + rng.uniform(-1, 1), y + rng.uniform(-1, 1)) for j in range(4000) for x, y in [(rng.uniform(0, 500), rng.uniform(0, 500))]]
    places = [(rng.uniform(0, 500), rng.uniform(0, 500)) for _ in range(60)]
    s, p = tables(spark, segs, [(i, "k", *places[i % 60]) for i in range(3000)])
    met, measured = [], N._measured
    monkeypatch.setattr(N, "_measured", lambda pairs, within: met.append(pairs) or measured(pairs, within))
    got = {r.pid: r.sid for r in N.nearest_within(p, s, "pid", ["kind"], 50.0, [], ["sid"]).collect()}
    assert got == {i: min((gap(places[i % 60], (a, b), (c, d)), j) for j, _, a, b, c, d in segs)[1] for i in range(3000)}
    assert sum(pairs.count() for pairs in met) <= 60 * 9 * N.FEW * 4


@pytest.mark.parametrize("seed", range(3))
def test_mixed_lengths_towns_and_far_points(spark, seed):
    """Dense and sparse places, lines from points to many cells long, ties between copies and layers, odd values."""
    rng = random.Random(seed)
    segs, side = [], 1000
    for j in range(700):
        x, y = (rng.gauss(200, 5), rng.gauss(700, 5)) if j % 3 else (rng.uniform(0, side), rng.uniform(0, side))
        n = rng.choice([0, 0.5, 3, 40, 600 if j % 50 == 0 else 4])
        segs.append((j, rng.choice("ab"), x, y, x + rng.uniform(-n, n), y + rng.uniform(-n, n)))
    segs += [(j + 1000, k, a, b, c, d) for j, k, a, b, c, d in segs[:60]]
    odd = [(5000, None, 1.0, 1.0, 2.0, 2.0), (5001, "a", float("inf"), 1.0, 2.0, 2.0), (5002, "a", float("nan"), 1.0, 2.0, 2.0), (5003, "a", None, 1.0, 2.0, 2.0)]
    points = [(i, rng.choice("abc"), *((rng.gauss(200, 9), rng.gauss(700, 9)) if i % 2 else (rng.uniform(-90, side + 90), rng.uniform(-90, side + 90)))) for i in range(250)]
    points += [(i, "b" if k == "a" else "a", x, y) for i, k, x, y in points[:50]]
    s, p = tables(spark, segs + odd, [*points, (900, "a", None, 1.0), (901, None, 1.0, 1.0), (902, "a", float("inf"), 1.0)])
    for leaf in (2, 256):
        got = {r.pid: (r.sid, round(r.distance, 6), r.kind) for r in N.nearest_within(p, s, "pid", ["kind"], 60.0, [], ["sid"], leaf).collect()}
        want = {}
        for i, k, x, y in points:
            best = min(((gap((x, y), (a, b), (c, d)), j, kk) for j, kk, a, b, c, d in segs if kk == k), default=None)
            if best and best[0] <= 60 and (i not in want or best < want[i]):
                want[i] = best
        assert got == {i: (j, round(d, 6), k) for i, (d, j, k) in want.items()} and len(want) > 100


def test_nothing_on_either_side(spark):
    s, p = tables(spark, [(1, "k", 0.0, 0.0, 1.0, 1.0)], [(1, "k", 0.0, 0.5)])
    for a, b in ((p.limit(0), s), (p, s.limit(0)), (p.limit(0), s.limit(0))):
        assert N.nearest_within(a, b, "pid", ["kind"], 5.0, [], ["sid"]).collect() == []


def test_segments_meet_places_without_what_their_keys_tell(spark, monkeypatch):
    """An order column that is a key decides between a point's rows, but is not shuffled with every segment; nor are a cell's two numbers."""
    segs = [(1, "a", 1, 0.0, 1.0, 9.0, 1.0), (2, "b", 0, 0.0, -1.0, 9.0, -1.0), (3, "a", 1, -9.0, -9.0, -8.0, -9.0), (4, "b", 0, -9.0, -11.0, -8.0, -11.0)]
    s = spark.createDataFrame(segs, "sid int, kind string, rank int, ax double, ay double, bx double, b_y double")
    points = [(i, k, r, x, y) for i, x, y in ((1, 4.0, 0.0), (2, 4.0, 0.5), (3, -8.5, -10.0)) for k, r in (("a", 1), ("b", 0))]
    p = spark.createDataFrame(points, "pid int, kind string, rank int, x double, y double")
    met, measured = [], N._measured
    monkeypatch.setattr(N, "_measured", lambda pairs, within: met.append(set(pairs.columns)) or measured(pairs, within))
    out = N.nearest_within(p, s, "pid", ["kind", "rank"], 5.0, ["kind"], ["rank", "sid"])
    assert {r.pid: (r.sid, r["rank"], r.kind, r.distance) for r in out.collect()} == {1: (2, 0, "b", 1.0), 2: (1, 1, "a", 0.5), 3: (4, 0, "b", 1.0)}
    assert not met[0] & {"rank", "kind", "cx", "cy"}


def test_far_cells_of_one_number_add_nothing_wrong(spark):
    """Cells 2^32 apart share their number; a segment there is a candidate whose distance rules it out."""
    c = spark.createDataFrame([(0, -1), (1 << 32, -1), (0, (1 << 32) - 1), (-1, 0), (-1, -1)], "cx long, cy long")
    a, b, c_, d, e = (r.cell for r in N._celled(c).collect())
    assert a == b == c_ and len({a, d, e}) == 3
    side = float(1 << 32) * 4
    s, p = tables(spark, [(1, "k", 3.0, 1.0, 3.5, 1.0), (2, "k", side, 0.0, side + 1, 0.0)], [(1, "k", 1.0, 1.0), (2, "k", side, 1.0), (3, "k", -side, 1.0)])
    assert {r.pid: r.sid for r in N.nearest_within(p, s, "pid", ["kind"], 5.0, [], ["sid"]).collect()} == {1: 1, 2: 2}
