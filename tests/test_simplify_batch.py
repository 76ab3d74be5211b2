"""Batches of lines: the flat way gives what line by line gives, and does not go line by line where it need not."""

import random

import numpy as np
import pyarrow as pa
import pytest

from wayside.functions import geometry as G
from wayside.functions.simplify import simplified

KIND = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def plain(paths, tolerance):
    """As it was done before: from rows to arrays and back."""
    if paths is None:
        return None
    whole = [p is not None and all(v is not None and v["x"] is not None and v["y"] is not None for v in p) for p in paths]
    found = iter(simplified([np.array([(v["x"], v["y"]) for v in p], np.float64).reshape(-1, 2) for p, w in zip(paths, whole, strict=True) if w], tolerance))
    return [[{"x": x, "y": y} for x, y in next(found).tolist()] if w else p for p, w in zip(paths, whole, strict=True)]


@pytest.mark.parametrize("odd", [0.0, 0.02])
def test_flat_batches(odd):
    rng = random.Random(7)

    def vertex():
        if rng.random() < odd:
            return rng.choice([None, {"x": None, "y": 1.0}, {"x": float("nan"), "y": 1.0}, {"x": 1.0, "y": float("inf")}])
        return {"x": rng.choice([0.0, 1.0, 2.0, rng.random() * 5]), "y": rng.choice([0.0, 1.0, rng.random() * 5])}

    def path():
        if rng.random() < odd:
            return None
        p = [vertex() for _ in range(rng.choice([0, 1, 2, 3, 3, 4, 5, 7, 60 if rng.random() < 0.05 else 4]))]
        return [*p, p[0]] if p and rng.random() < 0.3 else p

    rows = [None if rng.random() < odd else [path() for _ in range(rng.choice([0, 1, 1, 2, 3]))] for _ in range(3000)]
    whole = pa.array(rows, KIND)
    for batch, want in ((whole, rows), (whole.slice(11, 500), rows[11:511]), (whole.slice(0, 0), []), (pa.array([None, []], KIND), [None, []])):
        got = G.simplify_batch(batch, 0.7)
        assert got.type == KIND and repr(got.to_pylist()) == repr([plain(p, 0.7) for p in want])


def test_bends_are_done_at_once(monkeypatch):
    """Lines of three vertices never go one by one."""
    monkeypatch.setattr(G, "kept", None)
    monkeypatch.setattr(G, "kept_of_short", None)
    line = lambda h: [[{"x": 0.0, "y": 0.0}, {"x": 5.0, "y": h}, {"x": 9.0, "y": 0.0}]]
    got = G.simplify_batch(pa.array([line(1.0), line(3.0), None], KIND), 2.0).to_pylist()
    assert [None if p is None else len(p[0]) for p in got] == [2, 3, None]
