"""Line simplification that keeps topology: no simplified line crosses what it did not cross before.

Each path is simplified from coarse to fine: a stretch becomes one segment if all its
vertices are within the tolerance of it and it meets no other segment of the line, of this
or another path, as they stand at that moment, but at common ends; else it is divided at its farthest
vertex. Closed paths stay closed and keep four vertices, if they have them. Memory is
linear in the vertices: a stretch is compared with the line's segments in arrays.

Defined results: null stays null; paths of fewer than three vertices, or with vertices
that are null or not finite, stay as they are; vertices that repeat are within any tolerance.
"""

from __future__ import annotations

import math

import numpy as np


def _side(p: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    return (q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0])


def meets_inside(p: np.ndarray, q: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Whether the segment p-q meets the segments c-d elsewhere than at an end of both."""
    if not len(c):
        return np.zeros(0, bool)
    near = (np.minimum(c, d) <= np.maximum(p, q)).all(1) & (np.maximum(c, d) >= np.minimum(p, q)).all(1)
    out = np.zeros(len(c), bool)
    at = np.flatnonzero(near)
    if not len(at):
        return out
    c, d = c[at], d[at]
    s1, s2, s3, s4 = _side(p, q, c), _side(p, q, d), _side(c, d, p), _side(c, d, q)
    hit = (np.sign(s1) * np.sign(s2) < 0) & (np.sign(s3) * np.sign(s4) < 0)
    same = lambda a, b: (a == b).all(-1)
    inside = lambda r, a, b: (np.minimum(a, b) <= r).all(-1) & (r <= np.maximum(a, b)).all(-1) & ~same(r, a) & ~same(r, b)
    for side, r in ((s1, c), (s2, d)):
        hit |= (side == 0) & inside(r, p, q)
    for side, r in ((s3, p), (s4, q)):
        hit |= (side == 0) & inside(r, c, d)
    # a segment upon itself: both ends are common
    hit |= (same(p, c) & same(q, d) | same(p, d) & same(q, c)) & ~same(p, q)
    out[at] = hit
    return out


def _distances(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    step = b - a
    length = float(step @ step)
    t = np.clip((points - a) @ step / length, 0, 1) if length else np.zeros(len(points))
    return np.hypot(*(points - a - t[:, None] * step).T)


def simplified(paths: list[np.ndarray], tolerance: float) -> list[np.ndarray]:
    """Rows of x, y of each path of a line."""
    return [p if k is None else p[k] for p, k in zip(paths, kept(paths, tolerance), strict=True)]


def bends_kept(a: np.ndarray, b: np.ndarray, c: np.ndarray, tolerance: float) -> np.ndarray:
    """For many lines of one path a, b, c, which have no other segment to meet: whether b stays."""
    step = c - a
    length = (step * step).sum(1)
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        t = np.where(length > 0, np.clip(((b - a) * step).sum(1) / length, 0, 1), 0.0)
        gap = np.hypot(*(b - a - t[:, None] * step).T)
    return ~(np.isfinite(a) & np.isfinite(b) & np.isfinite(c)).all(1) | ~(gap <= tolerance)


def kept(paths: list[np.ndarray], tolerance: float) -> list[np.ndarray | None]:
    """Of each path of a line which vertices stay; None where the path stays as it is."""
    fine = [len(p) >= 3 and bool(np.isfinite(p).all()) for p in paths]
    first = np.cumsum([0, *[max(len(p) - 1, 0) for p in paths]])
    a = np.concatenate([p[:-1] for p in paths if len(p)] or [np.zeros((0, 2))])
    b = np.concatenate([p[1:] for p in paths if len(p)] or [np.zeros((0, 2))])
    stands = np.ones(len(a), bool)  # a stretch that became one segment stands in the place of its first
    ends = b.copy()
    out = []
    for k, p in enumerate(paths):
        if not fine[k]:
            out.append(None)
            continue
        n, base = len(p), int(first[k])
        keep = np.zeros(n, bool)
        keep[[0, n - 1]] = True
        closed = n >= 4 and bool((p[0] == p[-1]).all())
        todo, least = [(0, n - 1)], 3 if closed else 0
        while todo:
            lo, hi = todo.pop()
            if hi - lo < 2:
                continue
            gap = _distances(p[lo + 1 : hi], p[lo], p[hi])
            far = lo + 1 + int(gap.argmax())
            if not (closed and (hi - lo == n - 1 or keep.sum() <= least)) and gap.max() <= tolerance:
                others = stands.copy()
                others[base + lo : base + hi] = False
                at = np.flatnonzero(others)
                if not meets_inside(p[lo], p[hi], a[at], ends[at]).any():
                    stands[base + lo + 1 : base + hi] = False
                    ends[base + lo] = p[hi]
                    continue
            keep[far] = True
            todo += [(far, hi), (lo, far)]
        out.append(keep)
    return out


#: Lines of up to so many vertices are done by plain numbers, where arrays would cost more than they save.
SHORT = 48


def kept_of_short(paths: list[list[tuple[float, float]]], tolerance: float) -> list[list[bool] | None]:
    """kept() of a short line whose coordinates are all finite."""
    segments = [[a, b, True] for p in paths for a, b in zip(p, p[1:])]
    out, base = [], 0
    for p in paths:
        n = len(p)
        if n < 3:
            out.append(None)
            base += max(n - 1, 0)
            continue
        keep = [False] * n
        keep[0] = keep[-1] = True
        closed = n >= 4 and p[0] == p[-1]
        todo, least, count = [(0, n - 1)], 3 if closed else 0, 2
        while todo:
            lo, hi = todo.pop()
            if hi - lo < 2:
                continue
            far, gap = _farthest(p, lo, hi)
            if not (closed and (hi - lo == n - 1 or count <= least)) and gap <= tolerance:
                if not any(s[2] and not base + lo <= i < base + hi and _meet(p[lo], p[hi], s[0], s[1]) for i, s in enumerate(segments)):
                    for i in range(base + lo + 1, base + hi):
                        segments[i][2] = False
                    segments[base + lo][1] = p[hi]
                    continue
            count += not keep[far]
            keep[far] = True
            todo += [(far, hi), (lo, far)]
        out.append(keep)
        base += n - 1
    return out


def _farthest(p: list, lo: int, hi: int) -> tuple[int, float]:
    (ax, ay), (bx, by) = p[lo], p[hi]
    sx, sy = bx - ax, by - ay
    length, far, gap = sx * sx + sy * sy, lo + 1, -1.0
    for i in range(lo + 1, hi):
        dx, dy = p[i][0] - ax, p[i][1] - ay
        t = min(max((dx * sx + dy * sy) / length, 0.0), 1.0) if length else 0.0
        d = math.hypot(dx - t * sx, dy - t * sy)
        if d > gap:
            far, gap = i, d
    return far, gap


def _meet(p: tuple, q: tuple, c: tuple, d: tuple) -> bool:
    """meets_inside() of two segments."""
    for k in (0, 1):
        if min(c[k], d[k]) > max(p[k], q[k]) or max(c[k], d[k]) < min(p[k], q[k]):
            return False
    side = lambda a, b, r: (b[0] - a[0]) * (r[1] - a[1]) - (b[1] - a[1]) * (r[0] - a[0])
    s1, s2, s3, s4 = side(p, q, c), side(p, q, d), side(c, d, p), side(c, d, q)
    if (s1 < 0 < s2 or s2 < 0 < s1) and (s3 < 0 < s4 or s4 < 0 < s3):
        return True
    inside = lambda r, a, b: min(a[0], b[0]) <= r[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= r[1] <= max(a[1], b[1]) and r != a and r != b
    if s1 == 0 and inside(c, p, q) or s2 == 0 and inside(d, p, q) or s3 == 0 and inside(p, c, d) or s4 == 0 and inside(q, c, d):
        return True
    return p != q and (p == c and q == d or p == d and q == c)
