"""Quality classifier: Bradley-Terry pairwise ranking.

Each text gets cheap whole-text features (byte frequencies, repetition, word and
line statistics). Preference pairs (a document labelled 1 beats one labelled 0)
train a score by logistic loss on feature differences; the threshold is the
quantile of the training scores at the share of label 0, and the published score
is the probability that the document beats the threshold document.

The fit uses at most sample_rows labels and as many labelled rows (the smallest by a
hash of doc_id, then by place) and pairs_per_fit pairs; scoring is one map pass over
all whole texts.

Defined results: null and empty texts have zero features and get the model's
score for them; labels that are null or not 0 or 1 are not learned from; without
both labels every score is 0.5 (predicted 1); ids may be null or repeat; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import crc_bucket, sampled, split_rows, text_bytes

SAMPLE_ROWS = 8000
PAIRS_PER_FIT = 40000
N_FEATURES = 129 + 8


def features(column: pa.Array) -> np.ndarray:
    """One row of features for each text."""
    data, offsets = text_bytes(column)
    out = np.zeros((len(offsets) - 1, N_FEATURES))
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if a == b:
            continue
        x = np.bincount(data[a:b], minlength=256)
        n = b - a
        out[i, :128] = x[:128] / n
        out[i, 128] = x[128:].sum() / n
        raw = data[a:b].tobytes()
        words = raw.split()
        lines = raw.split(b"\n")
        seen = Counter(words)
        m = max(1, len(words))
        letters = x[65:91].sum() + x[97:123].sum() + x[128:].sum()
        out[i, 129:] = (
            np.log1p(n) / 10,
            x[65:91].sum() / max(1, letters),
            len(seen) / m,
            (max(seen.values()) if seen else 0) / m,
            sum(map(len, words)) / m / 10,
            len(set(lines)) / len(lines),
            sum(u == v for u, v in zip(words, words[1:], strict=False)) / m,
            letters / n,
        )
    return out


def _features_of(batches):
    for batch in batches:
        column = batch.column(2)
        data, offsets = text_bytes(column)
        for lo, hi in split_rows(offsets):
            x = features(column.slice(lo, hi - lo))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), values], ["uid", "quality", "x"])


def fit_bradley_terry(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS_PER_FIT, ridge: float = 1e-3, seed: int = 7) -> dict:
    """Weights by Newton steps on the mean logistic loss of winner minus loser."""
    mean, spread = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return {"mean": mean, "spread": spread, "w": w, "threshold": 0.0}
    z = np.clip((x - mean) / spread, -8, 8)
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    for _ in range(12):
        p = 1 / (1 + np.exp(d @ w))
        gradient = -(d * p[:, None]).mean(0) + ridge * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    raw = z @ w
    return {"mean": mean, "spread": spread, "w": w, "threshold": float(np.quantile(raw, len(bad) / len(y), method="midpoint"))}


def train_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", held_out: tuple[int, int] = (3, 1)) -> dict:
    """Model from at most sample_rows labelled rows outside the held-out fold."""
    known = labels.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), "quality").filter(F.col("quality").isin(0, 1) & F.col("id").isNotNull() & (crc_bucket("id", held_out[0]) != held_out[1]))
    known = known.join(F.broadcast(sampled(known.select("uid", "id"), sample_rows)), "uid", "left_semi").select("id", F.col("quality").cast("int").alias("quality")).distinct()
    found = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")
    first = found.select("uid", "id", "quality").orderBy(F.xxhash64("id"), "id", "uid", "quality").limit(sample_rows).select("uid", "quality")
    found = found.join(F.broadcast(first), ["uid", "quality"]).select("uid", "quality", "text")
    rows = found.mapInArrow(_features_of, "uid long, quality int, x array<double>").toPandas().sort_values(["uid", "quality"])
    x = np.stack(rows["x"].to_numpy()) if len(rows) else np.zeros((0, N_FEATURES))
    return fit_bradley_terry(x, rows["quality"].to_numpy())


def score_quality(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, and quality_score, for every row."""
    keep = docs.columns if keep is None else keep
    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]] + ["quality_score double"])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            _, offsets = text_bytes(column)
            parts = [np.zeros(0)]
            for lo, hi in split_rows(offsets):
                z = np.clip((features(column.slice(lo, hi - lo)) - model["mean"]) / model["spread"], -8, 8)
                parts.append(1 / (1 + np.exp(-np.clip(z @ model["w"] - model["threshold"], -60, 60))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(parts))], [*batch.schema.names[:-1], "quality_score"])

    return frame.mapInArrow(run, schema)
