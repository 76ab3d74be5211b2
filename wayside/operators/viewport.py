"""Viewport, table-page, sample and export queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.functions.geometry import crosses_box, in_box
from wayside.functions.text import viewer_key
from wayside.operators.prepare import first_row

VIEW_CAP = 25000
TABLE_ROWS, TABLE_COLUMNS = 500, 24


def capped(df: DataFrame, order: list, cap: int = VIEW_CAP) -> DataFrame:
    """The first rows in order, with total_in_view and truncated."""
    total = df.agg(F.count("*").alias("total_in_view"))
    return df.orderBy(*order).limit(cap).crossJoin(F.broadcast(total)).withColumn("truncated", F.col("total_in_view") > cap)


def points_in_view(points: DataFrame, key: str, west: float, south: float, east: float, north: float, cap: int = VIEW_CAP) -> DataFrame:
    return capped(points.filter(in_box(F.col("x"), F.col("y"), west, south, east, north)), [key], cap)


def lines_in_view(segments: DataFrame, key: str, west: float, south: float, east: float, north: float) -> DataFrame:
    """Ids of lines that truly meet the box: envelope test first (it prunes), then clipping."""
    envelope = (F.greatest("ax", "bx") >= west) & (F.least("ax", "bx") <= east) & (F.greatest("ay", "b_y") >= south) & (F.least("ay", "b_y") <= north)
    hit = crosses_box(*(F.col(c) for c in ("ax", "ay", "bx", "b_y")), west, south, east, north)
    return segments.filter(envelope).filter(hit).groupBy(key).agg(F.count("*").alias("segments_in_view"))


def bounds(vertices: DataFrame) -> DataFrame:
    """West, south, east, north and centre; coordinates that are not finite do not count."""
    fine = vertices.filter((F.abs("x") < float("inf")) & (F.abs("y") < float("inf")))
    b = fine.agg(F.min("x").alias("west"), F.min("y").alias("south"), F.max("x").alias("east"), F.max("y").alias("north"))
    return b.withColumn("center_x", (F.col("west") + F.col("east")) / 2).withColumn("center_y", (F.col("south") + F.col("north")) / 2)


def table_page(df: DataFrame, needle: str, sort_column: str, ascending: bool = True, rows: int = TABLE_ROWS, columns: int = TABLE_COLUMNS) -> DataFrame:
    """Rows any of whose values hold the needle, sorted: numbers first by value, then text; nulls last both ways."""
    shown = df.select(*df.columns[:columns])
    needle = needle.strip().lower()
    if needle:
        shown = shown.filter(reduce(lambda a, b: a | b, [F.coalesce(F.lower(F.col(c).cast("string")).contains(needle), F.lit(False)) for c in shown.columns]))
    text = F.col(sort_column).cast("string")
    number = text.try_cast("double")
    way = (lambda c: c.asc_nulls_last()) if ascending else (lambda c: c.desc_nulls_last())
    order = [text.isNull().asc(), way(number), way(text), *[F.col(c).asc_nulls_last() for c in shown.columns]]
    total = shown.agg(F.count("*").alias("total_rows"))
    return shown.orderBy(*order).limit(rows).crossJoin(F.broadcast(total))


def sample(df: DataFrame, key: str, n: int, seed: int = 17) -> DataFrame:
    """Exactly n rows (or all), the same ones each time: the smallest seeded hashes."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)


def geojson(df: DataFrame, kind: str, coordinates: Column, properties: list[str]) -> DataFrame:
    """One GeoJSON feature a line."""
    geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry")), {"ignoreNullFields": "false"}).alias("feature"))


def display_leaks(leaks: DataFrame, supp: DataFrame) -> DataFrame:
    """Leaks with the supplemental attributes of the first row of their viewer key."""
    s = supp.select(viewer_key("LeakNumber").alias("JoinLeakKey"), F.col("LeakMaterialType").alias("SuppLeakMaterialType"), F.col("Diameter").alias("SuppDiameter"), F.col("FacilityType").alias("SuppFacilityType"), "ordinal", F.struct("Diameter", "LeakMaterialType", "FacilityType", "Pressure").alias("__tie"))
    s = first_row(s.filter("JoinLeakKey <> ''"), "JoinLeakKey", ["ordinal", "__tie"]).drop("ordinal", "__tie")
    return leaks.withColumn("JoinLeakKey", viewer_key("leak_key_raw")).join(s, "JoinLeakKey", "left")
