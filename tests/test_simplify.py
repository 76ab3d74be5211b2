"""Simplification that keeps topology against a plain version; reference systems as column metadata; pairs of the nearest join."""

import itertools
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayside.functions import geometry as G
from wayside.functions import reference as R
from wayside.functions.simplify import simplified
from wayside.operators import nearest as N


def side(p, q, r):
    return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])


def meets(p, q, c, d):
    """Elsewhere than at an end of both, in exact arithmetic."""
    p, q, c, d = [tuple(map(Fraction, v)) for v in (p, q, c, d)]
    sign = lambda v: (v > 0) - (v < 0)
    s = [sign(side(p, q, c)), sign(side(p, q, d)), sign(side(c, d, p)), sign(side(c, d, q))]
    if s[0] * s[1] < 0 and s[2] * s[3] < 0:
        return True
    inside = lambda r, a, b: side(a, b, r) == 0 and min(a[0], b[0]) <= r[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= r[1] <= max(a[1], b[1]) and r not in (a, b)
    return inside(c, p, q) or inside(d, p, q) or inside(p, c, d) or inside(q, c, d) or (p != q and {p, q} == {c, d})


def gap(v, a, b):
    v, a, b = np.array(v), np.array(a), np.array(b)
    n = (b - a) @ (b - a)
    t = min(1.0, max(0.0, (v - a) @ (b - a) / n)) if n else 0.0
    return float(np.hypot(*(v - a - t * (b - a))))


def plain(paths, tolerance):
    """The same rule step by step over lists of segments."""
    now = [[(p[i], p[i + 1], k, i) for i in range(len(p) - 1)] for k, p in enumerate(paths)]
    out = []
    for k, p in enumerate(paths):
        if len(p) < 3:
            out.append(p)
            continue
        n, keep = len(p), {0, len(p) - 1}
        closed = n >= 4 and p[0] == p[-1]

        def go(lo, hi):
            if hi - lo < 2:
                return
            gaps = [gap(v, p[lo], p[hi]) for v in p[lo + 1 : hi]]  # noqa: B023
            may = not (closed and (hi - lo == n - 1 or len(keep) <= 3))  # noqa: B023
            others = [s for line in now for s in line if not (s[2] == k and lo <= s[3] < hi)]  # noqa: B023
            if may and max(gaps) <= tolerance and not any(meets(p[lo], p[hi], c, d) for c, d, *_ in others):  # noqa: B023
                now[k] = [s for s in now[k] if not lo <= s[3] < hi] + [(p[lo], p[hi], k, lo)]  # noqa: B023
                return
            far = lo + 1 + gaps.index(max(gaps))
            keep.add(far)  # noqa: B023
            go(lo, far)
            go(far, hi)

        go(0, n - 1)
        out.append([p[i] for i in sorted(keep)])
    return out


def walk(rng, n, closed, grid):
    p = [(rng.randrange(20), rng.randrange(20)) for _ in range(n)] if grid else list(itertools.accumulate([(rng.gauss(3, 2), rng.gauss(0, 3)) for _ in range(n)], lambda a, b: (a[0] + b[0], a[1] + b[1])))
    return [(float(x), float(y)) for x, y in (p + p[:1] if closed else p)]


@pytest.mark.parametrize("grid", [False, True])
def test_against_the_plain_version(grid):
    rng = random.Random(8)
    for turn in range(150):
        paths = [walk(rng, rng.randrange(2, 25), rng.random() < 0.4, grid) for _ in range(rng.randrange(1, 4))]
        tolerance = rng.choice([0.0, 0.5, 2.0, 6.0])
        got = [[tuple(v) for v in p.tolist()] for p in simplified([np.array(p) for p in paths], tolerance)]
        assert got == plain(paths, tolerance), turn
        for before, after in zip(paths, got, strict=True):
            assert after[0] == before[0] and after[-1] == before[-1]
            if len(before) >= 4 and before[0] == before[-1]:
                assert len(after) >= 4


def test_a_line_does_not_come_to_cross_its_neighbour():
    """The bow would be cut off across the pole that stands in it."""
    bow, pole = [(0, 0), (5, 2), (10, 0)], [(5, 1), (5, -9)]
    as_arrays = lambda *ps: [np.array(p, float) for p in ps]
    assert [len(p) for p in simplified(as_arrays(bow), 3.0)] == [2]
    assert [len(p) for p in simplified(as_arrays(bow, pole), 3.0)] == [3, 2]


def test_long_lines_and_odd_values(spark):
    t = np.linspace(0, 60, 20000)
    wave = np.stack([t * 100, 40 * np.sin(t)], axis=1)
    out = simplified([wave], 1.0)[0]
    assert 80 < len(out) < 1500 and (out[[0, -1]] == wave[[0, -1]]).all()
    rows = [(1, None), (2, []), (3, [[]]), (4, [[(1.0, 1.0)]]), (5, [[(0.0, 0.0), (float("nan"), 1.0), (2.0, 0.0)]]), (6, [[(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)], None]), (7, [[(0.0, 0.0), (None, 1.0), (2.0, 2.0)]])]
    df = spark.createDataFrame(rows, f"id int, paths {G.PATHS}")
    got = {r.id: r.p for r in df.select("id", G.simplify(F.col("paths"), 0.5).alias("p")).collect()}
    assert got[1] is None and got[2] == [] and got[3] == [[]] and len(got[4][0]) == 1 and len(got[5][0]) == 3 and [len(p or []) for p in got[6]] == [2, 0] and len(got[7][0]) == 3


def test_networks_query(spark):
    from wayside.plans.queries import QUERIES

    seen = 0
    for r in QUERIES["simplify_networks"](spark, "/root/testdata/sf0.001").limit(150).collect():
        paths = [[(v.x, v.y) for v in p] for p in r.paths]
        got = [[(v.x, v.y) for v in p] for p in r.kept_paths]
        assert got == plain(paths, 600.0) and (r.vertices, r.kept) == (sum(map(len, paths)), sum(map(len, got)))
        seen += r.kept < r.vertices
    assert seen > 10


def test_reference_systems(spark, tmp_path):
    points = spark.createDataFrame([(1, 1000.0, 2000.0), (2, None, None)], "id int, x double, y double")
    lines = spark.createDataFrame([(1, [[(0.0, 0.0), (5000.0, 9000.0)]]), (2, None), (3, [])], f"id int, {'paths ' + G.PATHS}")
    assert R.system_of(points) is None
    with pytest.raises(ValueError, match="not known"):
        R.to_system(points, R.DEGREES)
    p, s = R.assign_system(points, R.NATIVE), R.assign_system(lines, R.NATIVE)
    p.write.parquet(f"{tmp_path}/p")
    assert R.system_of(spark.read.parquet(f"{tmp_path}/p")) == R.NATIVE == R.system_of(p.filter("id > 0").select("x", "y"))
    assert R.to_system(p, R.NATIVE) is p and R.assign_system(p, R.NATIVE) is p
    with pytest.raises(ValueError, match="override"):
        R.assign_system(p, R.DEGREES)
    assert R.system_of(R.assign_system(p, R.DEGREES, override=True)) == R.DEGREES
    there = R.to_system(s, R.DEGREES)
    with pytest.raises(ValueError, match="several|different"):
        R.require_same_system(p, there)
    back = R.in_one_system(p, there)[1]
    assert R.require_same_system(p, back) == R.NATIVE
    got = {r.id: r.paths for r in back.collect()}
    assert got[2] is None and got[3] == [] and abs(got[1][0][1].x - 5000) < 0.01 and abs(got[1][0][1].y - 9000) < 0.01
    with pytest.raises(ValueError, match="no way"):
        R.to_system(p, 3857)
    with pytest.raises(ValueError, match="several"):
        R.system_of(p.withMetadata("y", {R.KEY: 1}))
    with pytest.raises(ValueError, match="no geometry"):
        R.system_of(points.select("id"))


def test_pairs_grow_with_the_rows_where_lines_are_dense(spark):
    """Four times the lines (short ones) and points in the same place: under six times the pairs, where all within the radius would be sixteen times."""
    def pairs(n):
        rng = random.Random(n)
        segs = [(j, "k", x, y, x + rng.uniform(-0.3, 0.3), y + rng.uniform(-0.3, 0.3)) for j in range(n) for x, y in [(rng.uniform(0, 100), rng.uniform(0, 100))]]
        s = spark.createDataFrame(segs, "sid int, kind string, ax double, ay double, bx double, b_y double")
        p = spark.createDataFrame([(i, "k", rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(n)], "pid int, kind string, px double, py double")
        tree = N.Quadtree(s, ["kind"], 50.0, ["sid"], leaf=4)
        return N.candidates(N.bounded(p, tree, "pid"), tree, "pid").count()

    few, many = pairs(1000), pairs(4000)
    assert few < 40 * 1000 and many < 6 * few


def test_far_points_and_piles_cost_no_more(spark):
    """A dense town seen from afar, and a pile of equal lines."""
    rng = random.Random(2)
    town = [(j, "k", x, y, x + 0.2, y + 0.2) for j in range(3000) for x, y in [(80 + rng.uniform(0, 10), 80 + rng.uniform(0, 10))]]
    pile = [(5000 + j, "k", 20.0, 20.0, 21.0, 21.0) for j in range(800)]
    s = spark.createDataFrame(town + pile, "sid int, kind string, ax double, ay double, bx double, b_y double")
    points = [(i, "k", 60 + rng.uniform(0, 3), 60 + rng.uniform(0, 3)) for i in range(200)] + [(1000 + i, "k", 20.5, 20.0 + i / 1000) for i in range(100)]
    p = spark.createDataFrame(points, "pid int, kind string, x double, y double")
    tree = N.Quadtree(s, ["kind"], 50.0, ["sid"], leaf=4)
    both = N.candidates(N.bounded(p.withColumnsRenamed({"x": "px", "y": "py"}), tree, "pid"), tree, "pid")
    assert both.filter("pid < 1000").count() < 200 * 300 and both.filter("pid >= 1000").count() <= 100 * 20
    got = {r.pid: r.sid for r in N.nearest_within(p, s, "pid", ["kind"], 50.0, [], ["sid"], leaf=4).collect()}
    for i, _, x, y in points[::25]:
        want = min((gap((x, y), (a, b), (c, d)), j) for j, _, a, b, c, d in town + pile)
        assert got.get(i) == (want[1] if want[0] <= 50 else None)
