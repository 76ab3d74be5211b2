import math
import random

import duckdb
from pyspark.sql import functions as F

from wayside.functions import geometry as G
from wayside.operators.nearest import _filed, _nine, nearest_within
from wayside.operators.viewport import bounds, capped, sample, table_page


def lines(spark, rows):
    return spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in p] for p in ps]) for k, ps in rows], f"id long, paths {G.PATHS}")


def test_segments_and_centroid(spark):
    df = lines(spark, [(1, [[(0, 0), (10, 0), (10, 10)]]), (2, [[(0, 0), (0, 2)], [(5, 5), (5, 9)]]), (3, [[(7, 7), (7, 7)]])])
    assert G.segments(df).count() == 5
    got = {r.id: (round(r.x, 6), round(r.y, 6)) for r in G.centroid(df, "id").collect()}
    assert got == {1: (7.5, 2.5), 2: (round(10 / 3, 6), 5.0), 3: (7.0, 7.0)}


def test_paths_and_wkt(spark):
    raw = spark.createDataFrame([(1, [[[0.0, 1.0, 9.0], [2.0, 3.0]], [[4.0, 4.0]]]), (2, None), (3, [])], "id int, raw array<array<array<double>>>")
    rows = raw.withColumn("p", G.clean_paths(F.col("raw"))).select("id", G.geometry_kind(F.col("p")).alias("kind"), F.size("p").alias("n"), F.when(F.size("p") > 0, G.line_wkt(F.col("p"))).alias("wkt")).orderBy("id").collect()
    assert (rows[0].kind, rows[0].n, rows[0].wkt) == ("LineString", 1, "LINESTRING (0.0 1.0, 2.0 3.0)")
    assert rows[1].kind is None and rows[2].kind is None


def test_projection_round_trip(spark):
    pts = [(-74.0, 43.0), (-71.06, 42.36), (-73.9, 40.9), (-70.0, 44.5)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    x, y = G.to_native(F.col("lon"), F.col("lat"))
    there = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = G.to_degrees(F.col("x"), F.col("y"))
    for r in there.select("*", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert abs(r.lon - r.lon2) < 1e-8 and abs(r.lat - r.lat2) < 1e-8  # a hundredth of a foot is 3e-8 degrees
        if (r.lon, r.lat) == (-74.0, 43.0):
            assert abs(r.x) < 1e-6 and abs(r.y) < 1e-6


def test_clip(spark):
    cases = [((-1, 0.5, 2, 0.5), True), ((-1, -1, -0.5, 2), False), ((0.2, 0.2, 0.3, 0.3), True), ((-1, 0.9, 0.9, 3), False), ((1, 1, 2, 2), True), ((0.5, 0.5, 0.5, 0.5), True), ((1.5, 0.5, 1.5, 0.6), False)]
    df = spark.createDataFrame([(i, *map(float, c)) for i, (c, _) in enumerate(cases)], "i int, ax double, ay double, bx double, b_y double")
    got = df.select("i", G.crosses_box(*(F.col(c) for c in ("ax", "ay", "bx", "b_y")), 0.0, 0.0, 1.0, 1.0).alias("hit")).orderBy("i").collect()
    assert [r.hit for r in got] == [w for _, w in cases]


def test_simplify(spark):
    df = lines(spark, [(1, [[(0, 0), (1, 0.01), (2, 0), (3, 5), (4, 0)]])])
    out = df.select(G.simplify(F.col("paths"), 0.1).alias("p")).first().p[0]
    assert [(v.x, v.y) for v in out] == [(0, 0), (2, 0), (3, 5), (4, 0)]


def test_nearest_against_brute_force(spark):
    rng = random.Random(9)
    points = [(i, rng.choice("ab"), rng.uniform(-500, 500), rng.uniform(-500, 500)) for i in range(150)]
    segs = []
    for j in range(120):
        x, y = rng.uniform(-500, 500), rng.uniform(-500, 500)
        segs.append((j, rng.choice("ab"), x, y, x + rng.uniform(-80, 80), y + rng.uniform(-80, 80)))
    segs += [(j + 1000, k, a, b, c, d) for j, k, a, b, c, d in segs[:40]]
    p = spark.createDataFrame(points, "pid int, kind string, x double, y double")
    s = spark.createDataFrame(segs, "sid int, kind string, ax double, ay double, bx double, b_y double")

    def dist(px, py, ax, ay, bx, by):
        dx, dy = bx - ax, by - ay
        n = dx * dx + dy * dy
        t = max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / n)) if n else 0.0
        return math.sqrt((px - ax - t * dx) ** 2 + (py - ay - t * dy) ** 2)

    want = {}
    for i, k, x, y in points:
        best = min(((dist(x, y, a, b, c, d), j) for j, kk, a, b, c, d in segs if kk == k), default=None)
        if best and best[0] <= 60:
            want[i] = best[1]
    for leaf, deepest in ((1, 16), (3, 16), (1, 1), (1000, 16)):
        got = {r.pid: r.sid for r in nearest_within(p, s, "pid", ["kind"], 60.0, [], ["sid"], leaf, deepest).collect()}
        assert got == want and len(want) > 50


def test_views(spark):
    df = spark.createDataFrame([(i, float(i), float("inf") if i == 3 else float(-i), None if i == 5 else str(100 - i) if i % 2 else f"t{i}") for i in range(10)], "id int, x double, y double, v string")
    b = bounds(df).first()
    assert (b.west, b.east, b.south, b.north) == (0.0, 9.0, -9.0, 0.0)
    rows = capped(df, ["id"], 4).collect()
    assert len(rows) == 4 and rows[0].total_in_view == 10 and rows[0].truncated
    assert sample(df, "id", 4).count() == 4 and sample(df, "id", 4).collect() == sample(df.repartition(3), "id", 4).collect()
    page = [r.v for r in table_page(df, "", "v").collect()]
    assert page == ["91", "93", "97", "99", "t0", "t2", "t4", "t6", "t8", None]
    assert table_page(df, "T", "v", ascending=False).first().total_rows == 6  # "Infinity" holds a t too


def test_degrees_round_as_sql_does(spark):
    """Next to a half the product with 10^7 decides, not the shortest text of the degrees."""
    ties = [-(73_000_000 + i) / 1e5 / 10 - 0.00000005 for i in range(0, 9_000, 7)] + [-73.57855095, -73.41853545, -73.42151295, 42.50000005, -0.00000005]
    df = spark.createDataFrame([(x,) for x in ties], "x double")
    rows = df.select("x", G.seven_places(F.col("x")).alias("r")).collect()
    con = duckdb.connect()
    con.execute("create table t (x double)")
    con.executemany("insert into t values (?)", [(r.x,) for r in rows])
    assert [r.r for r in rows] == [x for (x,) in con.execute("select round(x, 7) from t").fetchall()]


def test_cells_are_compiled(spark):
    """Segments are cut into parts and places meet their nine cells without functions that are interpreted for every row."""
    s = spark.createDataFrame([(1, 0.0, 0.0, 25.0, 0.0, 10.0), (2, 3.0, 3.0, 3.0, 3.0, 10.0)], "sid int, ax double, ay double, bx double, b_y double, width double")
    filed = _filed(s)
    assert sorted((r.sid, r.cx, r.cy) for r in filed.collect()) == [(1, 0, 0), (1, 1, 0), (1, 2, 0), (2, 0, 0)]
    nine = _nine(spark.createDataFrame([(-1.0, 14.0, 10.0)], "px double, py double, width double"))
    assert sorted((r.cx, r.cy) for r in nine.collect()) == [(x, y) for x in (-2, -1, 0) for y in (0, 1, 2)]
    for df in (filed, nine):
        assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
