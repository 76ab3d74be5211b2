"""Whole jobs over the operators: relocation with its full output columns, report, viewer
and date-bounded exports, and the refresh of a stored layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayside.functions.geometry import crosses_box, line_wkt, point_wkt, seven_places, simplify, to_degrees
from wayside.operators.enrich import already_enriched, decode_counts, enrich_pipes
from wayside.operators.export import date_export
from wayside.operators.outputs import guide_lines, match_leaks, one_row_per_id, relocated_leaks, relocation_audit
from wayside.operators.refresh import decide, delta_since
from wayside.operators.viewport import VIEW_CAP, bounds, capped, sample
from wayside.sources.pages import stored
from wayside.sources.snapshots import Layer

REPORT_ROWS = 250


# -- relocation --


def relocation_job(tasks: DataFrame, segments: DataFrame, order: list[str], run_utc: Column, **options) -> dict[str, DataFrame]:
    """The three output tables. tasks: leak_tasks with leak_gid; segments with pipe_gid. Of
    tasks with one leak id the last by `order` counts, whether it finds a pipe or not. The
    match is computed once and stored, and so are the tasks."""
    tasks = stored(one_row_per_id(tasks, "leak_oid", order))
    found = match_leaks(tasks, segments, carry=("pipe_gid",), **options)
    found = stored(found)
    gid = F.col("pipe_gid")
    moved = relocated_leaks(tasks, found, MatchedPipeGID=gid).withColumn("geometry", point_wkt(F.col("x"), F.col("y"))).drop("x", "y")
    lines = guide_lines(tasks, found).withColumn("geometry", _path_wkt("x0", "y0", "x1", "y1")).drop("x0", "y0", "x1", "y1")
    audit = relocation_audit(tasks, found, LeakGlobalID=F.col("leak_gid"), MatchedPipeGID=gid)
    audit = audit.withColumn("RunUTC", run_utc).withColumn("geometry", point_wkt(F.col("OrigX"), F.col("OrigY")))
    return {"relocated_leaks": moved, "relocated_leak_offset_lines": lines, "leak_relocation_audit": audit}


def _path_wkt(*names: str) -> Column:
    x0, y0, x1, y1 = (F.col(n) for n in names)
    return line_wkt(F.array(F.array(F.struct(x0.alias("x"), y0.alias("y")), F.struct(x1.alias("x"), y1.alias("y")))))


def enrich_job(pipes: DataFrame, decoder_rows: DataFrame, force: bool = False, dry_run: bool = False) -> tuple[str, DataFrame]:
    """What was done and its rows: 'skipped' and the pipes as they are if they hold decoded
    rows already (unless forced), 'counted' and the decode counts for a dry run, else 'enriched'."""
    if not force and already_enriched(pipes):
        return "skipped", pipes
    out = enrich_pipes(pipes, decoder_rows)
    return ("counted", decode_counts(out)) if dry_run else ("enriched", out)


def refresh_job(spark: SparkSession, folder: str, source: DataFrame, key: str, column: str | None, url: str, where: str, fresh_seconds: float = 3600) -> tuple[str, DataFrame]:
    """Bring a stored layer up to its source: as it is ('cache'), changed ('upsert') or reloaded.
    The watermark and the number of rows come from the layer's manifest, so the stored rows are
    not read for them; changes are written as such. A stop at any point leaves the version before."""
    layer = Layer(spark, folder, url, where)
    meta = layer.meta()
    if meta is not None and decide(meta["age_seconds"], fresh_seconds, meta["n"], None, None) == "cache":
        return "cache", layer.read()
    total = source.count()
    step = "reload"
    if meta is not None and column is not None and meta["max_modified_ms"] is not None:
        changes = delta_since(source, column, meta["max_modified_ms"])
        step = decide(None, fresh_seconds, meta["n"], total, changes.limit(1).count())
        if step == "upsert" and not layer.upsert(changes, key, column, total, expected=total):
            step = "reload"
    elif meta is not None and column is None:
        step = decide(None, fresh_seconds, meta["n"], total, 0)
    if step == "reload":
        layer.store(source, key, column, source_count=total)
    return step, layer.read()


# -- reports --


def report_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n) of every value of several columns, null among them, in one aggregation."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.column_name", "p.value").agg(F.count("*").alias("n"))


def report_rows(relocated: DataFrame, x: str = "x", y: str = "y", rows: int | None = REPORT_ROWS) -> DataFrame:
    """The report's table with geometry as WKT: the first rows by leak id, or all (rows=None)."""
    shown = relocated.withColumn("WKT", point_wkt(F.col(x), F.col(y))).drop(x, y)
    return shown if rows is None else shown.orderBy("OrigLeakOID").limit(rows)


# -- GeoJSON of lines and points, in degrees --


def _degrees(x: Column, y: Column) -> Column:
    lon, lat = to_degrees(x, y)
    return F.array(seven_places(lon), seven_places(lat))


def line_feature(paths: Column, properties: Sequence[str]) -> Column:
    """A feature of a line in native feet: LineString of one path, MultiLineString of several."""
    turned = F.transform(paths, lambda p: F.transform(p, lambda v: _degrees(v["x"], v["y"])))
    return _feature(F.when(F.size(paths) == 1, _geometry("LineString", turned[0])).otherwise(_geometry("MultiLineString", turned)), properties)


def point_feature(x: Column, y: Column, properties: Sequence[str]) -> Column:
    return _feature(_geometry("Point", _degrees(x, y)), properties)


def _geometry(kind: str, coordinates: Column) -> Column:
    return F.to_json(F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))


def _feature(geometry: Column, properties: Sequence[str]) -> Column:
    return F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*properties), {"ignoreNullFields": "false"}), F.lit(',"geometry":'), geometry, F.lit("}"))


def viewport_answer(lines: DataFrame, key: str, box: tuple[float, float, float, float], tolerance: float, properties: Sequence[str], cap: int = VIEW_CAP) -> DataFrame:
    """What a map view asks for: the first `cap` lines by key that truly meet the box, simplified,
    as GeoJSON, with total_in_view and truncated. Each line is tested in its own row, so nothing
    is shuffled but the lines in view; only the capped rows reach the simplifier."""
    edge = lambda p, i: crosses_box(F.get(p, i)["x"], F.get(p, i)["y"], F.get(p, i + 1)["x"], F.get(p, i + 1)["y"], *box)
    meets = F.exists("paths", lambda p: (F.size(p) > 1) & F.exists(F.sequence(F.lit(0), F.greatest(F.size(p) - 2, F.lit(0))), lambda i: F.coalesce(edge(p, i), F.lit(False))))
    shown = capped(lines.filter(meets), [key, "paths"], cap).withColumn("paths", simplify(F.col("paths"), tolerance)).filter("size(paths) > 0")
    return shown.select(key, line_feature(F.col("paths"), properties).alias("feature"), "total_in_view", "truncated")


def context_export(points: DataFrame, key: str, rows: int, seed: int = 17) -> DataFrame:
    """A seeded sample of a layer as GeoJSON, with the box of the sample in degrees."""
    drawn = sample(points, key, rows, seed)
    lon, lat = to_degrees(F.col("x"), F.col("y"))
    box = bounds(drawn.select(lon.alias("x"), lat.alias("y"))).select(*[seven_places(F.col(c)).alias(c) for c in ("west", "south", "east", "north")])
    return drawn.select(key, point_feature(F.col("x"), F.col("y"), [key]).alias("feature")).crossJoin(F.broadcast(box))


def viewer_export(relocated: DataFrame, guides: DataFrame, properties: Sequence[str], line_properties: Sequence[str]) -> DataFrame:
    """(layer, feature) of the output viewer: relocated points and the lines that lead to them."""
    path = F.array(F.array(F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))))
    points = relocated.select(F.lit("relocated_leaks").alias("layer"), point_feature(F.col("x"), F.col("y"), properties).alias("feature"))
    return points.unionByName(guides.select(F.lit("relocated_leak_offset_lines").alias("layer"), line_feature(path, line_properties).alias("feature")))


# -- date-bounded export --


def export_job(features: DataFrame, day: str, folder: str, dates: Sequence[str] = (), curated: Sequence[str] | None = None, count_only: bool = False) -> DataFrame | None:
    """Rows since a day: all as CSV under folder/csv, those with paths as GeoJSON lines under
    folder/geojson, written by as many tasks as there are rows' partitions. count_only writes
    nothing and returns one row with the number. Properties are the curated columns, or all."""
    rows = date_export(features, day, dates, [*curated, "paths"] if curated else None)
    if count_only:
        return rows.agg(F.count("*").alias("n"))
    table = [c for c in rows.columns if c != "paths"]
    rows.select(*table).write.option("header", True).csv(f"{folder}/csv")
    rows.filter("size(paths) > 0").select(line_feature(F.col("paths"), table).alias("value")).write.text(f"{folder}/geojson")
    return None
