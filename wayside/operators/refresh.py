"""Incremental refresh: watermark, delta, upsert and the refresh decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.functions.text import LATEST_MS, epoch_ms, safe_watermark


def watermark(df: DataFrame, column: str, *by: str) -> DataFrame:
    """One row (or one for each group): the latest modification as a timestamp on whole seconds (1970 if there is none)."""
    return df.groupBy(*by).agg(F.max(epoch_ms(column)).alias("ms")).select(*by, "ms", safe_watermark("ms").alias("watermark"))


def delta(source: DataFrame, cached: DataFrame, column: str, base: Column | None = None) -> DataFrame:
    """Rows of the source modified after the cached watermark; the comparison is strict."""
    rows = source if base is None else source.filter(base)
    mark = watermark(cached, column).select("watermark")
    modified = F.timestamp_millis(epoch_ms(column))
    return rows.crossJoin(F.broadcast(mark)).filter(modified > F.col("watermark")).drop("watermark")


def delta_since(source: DataFrame, column: str, mark_ms: int | None, base: Column | None = None) -> DataFrame:
    """Rows modified after a watermark that is known: over whole numbers the comparison reaches the scan."""
    rows = source if base is None else source.filter(base)
    second = mark_ms // 1000 * 1000 if mark_ms is not None and 0 < mark_ms <= LATEST_MS else 0
    whole = source.schema[column].dataType.typeName() in ("byte", "short", "integer", "long")
    modified = F.col(column) if whole else epoch_ms(column)
    return rows.filter(modified > F.lit(second).cast("long"))


def upsert(cached: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Cached rows whose id (as text) is not among the changes, and the changes; columns may differ."""
    ids = changes.select(F.col(key).cast("string").alias("__id")).filter("__id is not null").distinct()
    kept = cached.withColumn("__id", F.col(key).cast("string")).join(ids, "__id", "left_anti").drop("__id")
    return kept.unionByName(changes, allowMissingColumns=True)


def decide(age_seconds: float | None, fresh_seconds: float, cached_rows: int | None, source_rows: int | None, delta_rows: int | None) -> str:
    """cache, upsert (to be accepted only if the counts then agree) or reload."""
    if cached_rows is None:
        return "reload"
    if age_seconds is not None and age_seconds <= fresh_seconds:
        return "cache"
    if delta_rows == 0:
        return "cache" if cached_rows == source_rows else "reload"
    return "upsert"


def refresh(cached: DataFrame, source: DataFrame, key: str, column: str, age_seconds: float | None = None, fresh_seconds: float = 3600) -> tuple[str, DataFrame]:
    """The layer to use and how it came about: deletes show only as counts that disagree."""
    if decide(age_seconds, fresh_seconds, 0, None, None) == "cache":
        return "cache", cached
    changes = delta(source, cached, column)
    total = source.count()
    step = decide(age_seconds, fresh_seconds, cached.count(), total, changes.limit(1).count())
    if step != "upsert":
        return step, cached if step == "cache" else source
    merged = upsert(cached, changes, key)
    return ("upsert", merged) if merged.count() == total else ("reload", source)
