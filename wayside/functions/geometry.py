"""Geometry on nested columns: points are x, y; lines are arrays of paths of (x, y) structs."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.functions.simplify import SHORT, bends_kept, kept, kept_of_short

# The native equidistant conic projection (US survey feet on WGS84).
SEMI_MAJOR_FT = 6378137.0 / 0.3048006096012192
FLATTENING = 1 / 298.257223563
PARALLEL_1, PARALLEL_2, ORIGIN_LAT, CENTRAL_LON = 42.0, 44.0, 43.0, -74.0
DEFAULT_BOUNDS = {"west": -72.5, "south": 41.0, "east": -69.5, "north": 43.0}
PATHS = "array<array<struct<x:double,y:double>>>"


def clean_paths(raw: Column) -> Column:
    """Paths of coordinate arrays as paths of structs: extra dimensions go, paths of under two vertices too."""
    points = F.transform(raw, lambda p: F.transform(p, lambda v: F.struct(v[0].cast("double").alias("x"), v[1].cast("double").alias("y"))))
    return F.filter(points, lambda p: F.size(p) >= 2)


def geometry_kind(paths: Column) -> Column:
    return F.when(F.size(paths) == 1, "LineString").when(F.size(paths) > 1, "MultiLineString")


def segments(lines: DataFrame, paths: str = "paths") -> DataFrame:
    """One row per segment: the other columns, path_idx, seg_idx, ax, ay, bx, b_y."""
    rest = [c for c in lines.columns if c != paths]
    one = lines.select(*rest, F.posexplode(paths).alias("path_idx", "path"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("path") - 2), lambda i: F.struct(F.get("path", i).alias("a"), F.get("path", i + 1).alias("b")))
    two = one.filter(F.size("path") >= 2).select(*rest, "path_idx", F.posexplode(pairs).alias("seg_idx", "s"))
    return two.select(*rest, "path_idx", "seg_idx", F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("b_y"))


def nearest_on_segment(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> tuple[Column, Column]:
    """The closest point of a segment."""
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / length))).otherwise(F.lit(0.0))
    return ax + t * dx, ay + t * dy


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def centroid(lines: DataFrame, key: str) -> DataFrame:
    """(key, x, y): length-weighted mean of the segments' midpoints; the first vertex of a line without length."""
    s = segments(lines)
    n = distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("b_y"))
    sums = s.withColumn("n", n).groupBy(key).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("ax") + F.col("bx")) / 2).alias("sx"), F.sum(F.col("n") * (F.col("ay") + F.col("b_y")) / 2).alias("sy"), F.min(F.struct("path_idx", "seg_idx", "ax", "ay")).alias("first")
    )
    return sums.select(key, F.when(F.col("n") > 0, F.col("sx") / F.col("n")).otherwise(F.col("first.ax")).alias("x"), F.when(F.col("n") > 0, F.col("sy") / F.col("n")).otherwise(F.col("first.ay")).alias("y"))


def in_box(x: Column, y: Column, west: float, south: float, east: float, north: float) -> Column:
    return x.between(west, east) & y.between(south, north)


def crosses_box(ax: Column, ay: Column, bx: Column, by: Column, west: float, south: float, east: float, north: float) -> Column:
    """Whether a segment meets a box: Liang-Barsky clipping."""
    dx, dy = bx - ax, by - ay
    sides = ((-dx, ax - west), (dx, F.lit(east) - ax), (-dy, ay - south), (dy, F.lit(north) - ay))
    enter = F.greatest(F.lit(0.0), *[F.when(p < 0, q / p) for p, q in sides])  # null where the side does not bound
    leave = F.least(F.lit(1.0), *[F.when(p > 0, q / p) for p, q in sides])
    outside = [(p == 0) & (q < 0) for p, q in sides]
    return ~(outside[0] | outside[1] | outside[2] | outside[3]) & (enter <= leave)


def point_wkt(x: Column, y: Column) -> Column:
    return F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))


def line_wkt(paths: Column) -> Column:
    parts = F.transform(paths, lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, lambda v: F.concat_ws(" ", v["x"].cast("string"), v["y"].cast("string"))), ", "), F.lit(")")))
    return F.when(F.size(paths) == 1, F.concat(F.lit("LINESTRING "), parts[0])).otherwise(F.concat(F.lit("MULTILINESTRING ("), F.array_join(parts, ", "), F.lit(")")))


# -- projection --


def _meridian_series() -> tuple[list[float], float]:
    e2 = FLATTENING * (2 - FLATTENING)
    e4, e6 = e2 * e2, e2 * e2 * e2
    return [1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256, 3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024, 15 * e4 / 256 + 45 * e6 / 1024, 35 * e6 / 3072], e2


def _arc(lat: float) -> float:
    m, _ = _meridian_series()
    return m[0] * lat - m[1] * math.sin(2 * lat) + m[2] * math.sin(4 * lat) - m[3] * math.sin(6 * lat)


def conic_constants() -> dict[str, float]:
    """Cone constant and radii of the projection, in units of the semi-major axis."""
    _, e2 = _meridian_series()
    f1, f2, f0 = map(math.radians, (PARALLEL_1, PARALLEL_2, ORIGIN_LAT))
    scale = lambda f: math.cos(f) / math.sqrt(1 - e2 * math.sin(f) ** 2)
    n = (scale(f1) - scale(f2)) / (_arc(f2) - _arc(f1))
    g = scale(f1) / n + _arc(f1)
    return {"n": n, "g": g, "rho0": g - _arc(f0)}


def to_native(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to native feet."""
    m, _ = _meridian_series()
    k = conic_constants()
    f = F.radians(lat)
    arc = m[0] * f - m[1] * F.sin(2 * f) + m[2] * F.sin(4 * f) - m[3] * F.sin(6 * f)
    rho, theta = k["g"] - arc, k["n"] * F.radians(lon - CENTRAL_LON)
    return SEMI_MAJOR_FT * rho * F.sin(theta), SEMI_MAJOR_FT * (k["rho0"] - rho * F.cos(theta))


def to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """Native feet to degrees, by the inverse meridian series."""
    m, e2 = _meridian_series()
    k = conic_constants()
    e = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    px, py = x / SEMI_MAJOR_FT, k["rho0"] - y / SEMI_MAJOR_FT
    mu = (k["g"] - F.sqrt(px * px + py * py)) / m[0]
    lat = mu + (3 * e / 2 - 27 * e**3 / 32) * F.sin(2 * mu) + (21 * e**2 / 16 - 55 * e**4 / 32) * F.sin(4 * mu) + (151 * e**3 / 96) * F.sin(6 * mu) + (1097 * e**4 / 512) * F.sin(8 * mu)
    return CENTRAL_LON + F.degrees(F.atan2(px, py) / k["n"]), F.degrees(lat)


def seven_places(degrees: Column) -> Column:
    """Degrees to seven places, a half away from zero: what counts is the product with 10^7 as a double, as in
    SQL's round. round(degrees, 7) goes by the shortest text of the degrees instead, and differs next to a half."""
    return F.round(degrees * 1e7) / 1e7


def simplify(paths: Column, tolerance: float) -> Column:
    """Lines simplified at a tolerance, topology kept (wayside.functions.simplify): the one recursive piece, in Arrow batches."""

    @F.arrow_udf(PATHS)
    def run(column: pa.Array) -> pa.Array:
        return simplify_batch(column, tolerance)

    return run(paths)


def simplify_batch(column: pa.Array, tolerance: float) -> pa.Array:
    """A batch of lines: vertices stay in flat arrays, and only a mask tells which go. Lines of one path
    of three vertices are done at once, others one by one. Paths with a null in them stay as they are."""
    # offsets into what is valid: slices and nulls with rows behind them are straightened first
    lines = column.take(pa.array(np.arange(len(column)))) if column.offset or column.null_count else column
    ends = lines.offsets.to_numpy()
    parts = lines.values
    cuts = parts.offsets.to_numpy() if len(parts) else np.zeros(1, np.int32)
    vertices = parts.values
    whole = np.asarray(vertices.is_valid()) if vertices.null_count else np.ones(len(vertices), bool)
    x, y = (vertices.field(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("x", "y"))
    for c in ("x", "y"):
        if vertices.field(c).null_count:
            whole &= np.asarray(vertices.field(c).is_valid())
    xy = np.column_stack([x, y])
    stays = np.ones(len(xy), bool)
    broken = np.concatenate([[0], np.cumsum(~whole)])
    sizes = np.diff(cuts)
    single = np.flatnonzero(np.diff(ends) == 1)
    bend = ends[:-1][single]
    bend = bend[(sizes[bend] == 3) & (broken[cuts[bend + 1]] == broken[cuts[bend]])] if len(bend) else bend
    b = cuts[bend]
    if len(b):
        stays[b + 1] = bends_kept(xy[b], xy[b + 1], xy[b + 2], tolerance)
    done = np.zeros(len(parts), bool)
    done[bend] = True
    odd = np.concatenate([[0], np.cumsum(~(whole & np.isfinite(xy).all(1)))]).tolist()
    points, at = list(zip(x.tolist(), y.tolist(), strict=True)), cuts.tolist()
    for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if hi == lo or hi - lo == 1 and done[lo] or at[hi] - at[lo] < 3:
            continue
        if at[hi] - at[lo] <= SHORT and odd[at[hi]] == odd[at[lo]]:
            for k, keep in enumerate(kept_of_short([points[at[k] : at[k + 1]] for k in range(lo, hi)], tolerance), lo):
                if keep is not None:
                    stays[at[k] : at[k + 1]] = keep
            continue
        own = [k for k in range(lo, hi) if broken[cuts[k + 1]] == broken[cuts[k]]]
        for k, keep in zip(own, kept([xy[cuts[k] : cuts[k + 1]] for k in own], tolerance), strict=True):
            if keep is not None:
                stays[cuts[k] : cuts[k + 1]] = keep
    left = np.concatenate([[0], np.cumsum(stays)]).astype(np.int32)
    mask = lambda a: pa.array(np.asarray(a.is_null())) if a.null_count else None
    kind = column.type
    new = pa.ListArray.from_arrays(pa.array(left[cuts]), vertices.filter(pa.array(stays)), type=kind.value_type, mask=mask(parts))
    return pa.ListArray.from_arrays(pa.array(ends), new, type=kind, mask=mask(lines))
