"""Registered queries of the relocation toolkit over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayside.functions import geometry as G
from wayside.functions.material import layer_color, material_family, material_label, route_layers, row_family, search_ring, viewer_family
from wayside.functions.reference import DEGREES, NATIVE, assign_system, in_one_system, require_same_system, to_system
from wayside.functions.text import clean, epoch_ms, norm_code, normalize_key, parse_number, safe_watermark, viewer_key
from wayside.operators import enrich as E
from wayside.operators import jobs as J
from wayside.operators import outputs as O
from wayside.operators import refresh as R
from wayside.operators import viewport as V
from wayside.operators.clustered import lines_near_view, write_clustered
from wayside.operators.export import choose_since, date_export
from wayside.operators.prepare import last_row, leak_tasks, pipe_gaps, prepared_pipes, supplemental
from wayside.plans import workload as W
from wayside.sources.feature_source import IndexedFeatureSource, write_pages
from wayside.sources.pages import features, fetched_pages, layer_schema, page_texts, read_snapshot, read_supplemental, scratch_folder, stored, write_csv, write_snapshot
from wayside.sources.snapshots import Layer
from wayside.streaming.refresh_stream import refresh_stream

BOX = (40000.0, 40000.0, 70000.0, 60000.0)
STREAM_FILES = 8
SINCE_MS = 820454400000  # 1996-01-01
RUN_UTC = "2024-01-01 00:00:00"


def _matches(spark, d, **options) -> tuple[DataFrame, DataFrame]:
    """The tasks, stored as the match and its outputs both read them, and the matches."""
    tasks = stored(W.tasks(spark, d))
    return tasks, O.match_leaks(tasks, W.segment_table(spark, d), **options)


def _wide(spark, d):
    """The supplemental rows with keys, numbers and dates as doubles beyond 10^7, and a NaN here and there."""
    n = F.substring("LeakNumber", 4, 20).cast("double")
    return W.raw_supplemental(spark, d).withColumns({"wide": n * 1000003, "holed": F.when(n % 5 == 0, float("nan")).otherwise(n * 4096 + 0.5)})


def clean_keys(spark, d):
    wide = [normalize_key("wide").alias("wide_key"), viewer_key("wide").alias("wide_view"), norm_code("wide").alias("wide_code"), clean("holed").alias("holed")]
    return _wide(spark, d).select(*wide, "LeakNumber", "ordinal", clean("LeakMaterialType").alias("cleaned"), normalize_key("LeakNumber").alias("join_key"), viewer_key("LeakNumber").alias("view_key"), norm_code("Pressure").alias("code"))


def parse_numbers(spark, d):
    return _wide(spark, d).select(parse_number("wide").alias("wide"), parse_number("holed").alias("holed"), "LeakNumber", "ordinal", parse_number("Diameter").alias("diameter"), parse_number("LeakMaterialType").alias("in_material"))


def _by_material(spark, d, **columns):
    return W.raw_supplemental(spark, d).groupBy("LeakMaterialType").agg(F.count("*").alias("n")).select("LeakMaterialType", "n", *[c.alias(k) for k, c in columns.items()])


def decode_material(spark, d):
    return _by_material(spark, d, label=material_label("LeakMaterialType"))


def family_match(spark, d):
    return _by_material(spark, d, family=material_family("LeakMaterialType"))


def family_row(spark, d):
    return _by_material(spark, d, family=row_family("LeakMaterialType"))


def family_viewer(spark, d):
    return _by_material(spark, d, family=viewer_family("LeakMaterialType"))


def route_layers_query(spark, d):
    s = W.raw_supplemental(spark, d).withColumn("layer", F.explode(route_layers("FacilityType")))
    return s.groupBy("FacilityType", "layer").agg(F.count("*").alias("n")).withColumn("color", layer_color("layer"))


def search_ring_query(spark, d):
    _, m = _matches(spark, d)
    return m.groupBy(search_ring("distance").alias("ring")).agg(F.count("*").alias("n"))


def supplement_leaks(spark, d):
    return W.gated(spark, d).select("leak_oid", "leak_key", "leak_diameter", "leak_material", "leak_pressure", "facility", "gate")


def leak_gate_counts(spark, d):
    return W.gated(spark, d).groupBy("gate").agg(F.count("*").alias("n"))


def prepare_pipes_counts(spark, d):
    return pipe_gaps(prepared_pipes(W.pipes(spark, d), "assettype"))


def enrich_pipes(spark, d):
    return W.enriched(spark, d).select("pipe_oid", "ASSETGROUP_DECODED", "ASSETTYPE_DECODED", "ASSETTYPE_DOMAIN", "PipeMaterialFamily", F.col("PipeMaterialRaw").cast("long").alias("PipeMaterialRaw"), "material")


def decode_counts(spark, d):
    return E.decode_counts(W.enriched(spark, d))


def preflight_profile(spark, d):
    return E.fill_profile(W.enriched(spark, d), ["ASSETGROUP", "ASSETTYPE", "ASSETTYPE_DECODED", "PipeMaterialFamily", "GradeMaterial"])


def family_collapse(spark, d):
    return E.collapsed(W.enriched(spark, d))


def relocated_leaks(spark, d):
    return O.relocated_leaks(*_matches(spark, d))


def relocated_leaks_strict(spark, d):
    return O.relocated_leaks(*_matches(spark, d, family_fallback=False, require_pressure=True))


def guide_lines(spark, d):
    return O.guide_lines(*_matches(spark, d))


def relocation_audit(spark, d):
    return O.relocation_audit(*_matches(spark, d))


def run_counters(spark, d):
    gated = stored(W.gated(spark, d))
    return O.run_counters(gated, O.match_leaks(leak_tasks(gated), W.segment_table(spark, d)))


def _audit(spark, d):
    tasks, m = _matches(spark, d)
    return E.audit_output(O.relocated_leaks(tasks, m), W.enriched(spark, d))


def audit_agreement(spark, d):
    return E.audit_totals(_audit(spark, d))


def audit_disagreements(spark, d):
    return _audit(spark, d).filter("not equals_decoded").select("OrigLeakOID", "LinkedLayer", "MatchedPipeOID", "MatchMaterial", "PipeCache_ASSETTYPE_DECODED")


def distance_describe(spark, d):
    _, m = _matches(spark, d)
    out = E.describe(m, "distance")
    return out.select("n", *[F.round(c, 3).alias(c) for c in out.columns if c != "n"])


def value_counts(spark, d):
    return E.value_counts(W.enriched(spark, d), "ASSETTYPE_DECODED")


def family_impact(spark, d):
    return E.family_impact(W.raw_supplemental(spark, d), "LeakMaterialType")


def affected_rows(spark, d):
    return E.affected_rows(W.raw_supplemental(spark, d), "LeakMaterialType").select("LeakNumber", "ordinal", "LeakMaterialType")


def impact_share(spark, d):
    return E.impact_share(W.raw_supplemental(spark, d), "LeakMaterialType")


def wanted_rows(spark, d):
    """Fetched pipes that are wanted for their diameter; the service pipes' ids come as text that is no integer."""
    p = W.pipes(spark, d)
    oid = F.col("pipe_oid").cast("string")
    fetched = p.select(F.when(F.col("layer") == "service", F.concat(F.lit("S-"), oid)).otherwise(oid).alias("OBJECTID"), "nominaldiameter")
    return E.wanted_rows(fetched, p.filter("nominaldiameter >= 2"), "OBJECTID", "pipe_oid")


def relocated_sample(spark, d):
    return E.first_rows(relocated_leaks(spark, d).select("OrigLeakOID", "LinkedLayer", "MatchedPipeOID", "MatchMaterial"), ["OrigLeakOID"], 25)


def layer_bounds(spark, d):
    s = W.segment_table(spark, d)
    ends = s.select(F.explode(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("b_y").alias("y")))).alias("v")).select("v.*")
    return V.bounds(ends.union(W.leaks(spark, d).select("x", "y")))


def viewport_points(spark, d):
    return V.points_in_view(W.leaks(spark, d).select("leak_oid", "x", "y"), "leak_oid", *BOX)


def viewport_lines(spark, d):
    return V.lines_in_view(W.segment_table(spark, d), "pipe_oid", *BOX)


def layer_sample(spark, d):
    return V.sample(W.leaks(spark, d), "leak_oid", 3500)


def table_page(spark, d):
    return V.table_page(spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), " 7 ", "c_custkey", ascending=False)


def _degrees(spark, d):
    x, y = G.to_degrees(F.col("x"), F.col("y"))
    return W.leaks(spark, d).select("leak_oid", "x", "y", x.alias("lon"), y.alias("lat"))


def reproject_points(spark, d):
    e7 = lambda c: F.round(F.col(c) * 1e7).cast("long")
    bx, by = G.to_native(F.col("lon"), F.col("lat"))
    back = _degrees(spark, d).withColumn("drift", G.distance(F.col("x"), F.col("y"), bx, by))
    return back.select("leak_oid", e7("lon").alias("lon_e7"), e7("lat").alias("lat_e7"), (F.col("drift") < 0.01).alias("round_trip"))


PIPE_PATHS = "array(array(struct(x1 as x, y1 as y), struct(x1 + dx as x, y1 + dy as y), struct(x1 + dx + dy as x, y1 + dy - dx as y)))"


def _lines(spark, d):
    return W.pipes(spark, d).select("pipe_oid", "layer", F.expr(PIPE_PATHS).alias("paths"))


def simplify_lines(spark, d):
    out = _lines(spark, d).withColumn("paths", G.simplify(F.col("paths"), 120.0))
    return out.select("pipe_oid", F.size(F.col("paths")[0]).cast("long").alias("vertices"))


def simplify_networks(spark, d):
    """Orders as lines through their pipes, the odd ones closed, each with a second path beside it: vertices before and after, topology kept."""
    p = W.pipes(spark, d).select(F.expr("pipe_oid div 1000 div 100000 div 10").alias("orderkey"), "pipe_oid", (F.col("x1") % 4000).alias("x"), (F.col("y1") % 4000).alias("y"))
    one = p.groupBy("orderkey").agg(F.array_sort(F.collect_list(F.struct("pipe_oid", "x", "y"))).alias("v"))
    path = F.transform("v", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    first = F.when(F.col("orderkey") % 2 == 1, F.concat(path, F.slice(path, 1, 1))).otherwise(path)
    beside = F.transform("v", lambda v: F.struct((v["x"] + 900).alias("x"), v["y"].alias("y")))
    lines = one.select("orderkey", F.array(first, beside).alias("paths"))
    out = lines.withColumn("kept", G.simplify(F.col("paths"), 600.0))
    size = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, p: n + F.size(p))
    return out.select("orderkey", size("paths").alias("vertices"), size("kept").alias("kept"), "paths", F.col("kept").alias("kept_paths"))


def two_systems(spark, d):
    """Leaks in native feet and pipes in degrees, brought into the leading layer's system, as the job does."""
    leaks = assign_system(W.leaks(spark, d).select("leak_oid", "x", "y"), NATIVE)
    pipes = to_system(assign_system(_lines(spark, d), NATIVE), DEGREES)  # as another service delivers them
    leaks, pipes = in_one_system(leaks, pipes)
    require_same_system(leaks, pipes)
    first = F.col("paths")[0][0]
    ends = pipes.select("layer", F.col("pipe_oid").alias("id"), F.round(first["x"]).alias("x"), F.round(first["y"]).alias("y"))
    return leaks.select(F.lit("leaks").alias("layer"), F.col("leak_oid").alias("id"), F.col("x"), F.col("y")).union(ends)


def line_centroids(spark, d):
    c = G.centroid(_lines(spark, d).dropDuplicates(["pipe_oid"]), "pipe_oid")
    return c.select("pipe_oid", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


def geojson_features(spark, d):
    p = _degrees(spark, d)
    return V.geojson(p, "Point", F.array(G.seven_places(F.col("lon")), G.seven_places(F.col("lat"))), ["leak_oid"])


def wkt_export(spark, d):
    i = lambda c: c.cast("long")
    p = W.pipes(spark, d)
    v = lambda x, y: F.struct(i(x).alias("x"), i(y).alias("y"))
    c = F.col
    return p.select("pipe_oid", G.line_wkt(F.array(F.array(v(c("x1"), c("y1")), v(c("x1") + c("dx"), c("y1") + c("dy"))))).alias("wkt"))


def _events(spark, d):
    """The events, and a copy that ends at nine tenths of their time with all types old."""
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("modified", F.unix_millis(F.col("ts").cast("timestamp")))
    return e, _until(e, 9).withColumn("event_type", F.lit("old"))


def _until(e, tenths):
    """The rows of the first tenths of a table's time."""
    bound = e.agg(F.expr(f"min(modified) + (max(modified) - min(modified)) * {tenths} div 10").alias("bound"))
    return e.crossJoin(F.broadcast(bound)).filter("modified <= bound").drop("bound")


def upsert_layer(spark, d):
    """The older nine tenths, changed by every event of the later half."""
    e, cached = _events(spark, d)
    changes = e.join(_until(e, 5).select("event_id"), "event_id", "left_anti")
    return R.upsert(cached.select("event_id", "event_type"), changes.select("event_id", "event_type", "user_id"), "event_id")


def delta_rows(spark, d):
    e, cached = _events(spark, d)
    return R.delta(e, cached, "modified", F.col("event_type") != "error").select("event_id", "event_type")


def refresh_watermark(spark, d):
    """The watermark of every type of event."""
    e, _ = _events(spark, d)
    w = R.watermark(e, "modified", "event_type")
    return w.select("event_type", "ms", F.date_format("watermark", "yyyy-MM-dd HH:mm:ss").alias("watermark"))


def refresh_watermark_all(spark, d):
    """The watermark of the whole table."""
    e, _ = _events(spark, d)
    w = R.watermark(e, "modified")
    return w.select("ms", F.date_format("watermark", "yyyy-MM-dd HH:mm:ss").alias("watermark"))


def refresh_decision(spark, d):
    """What refreshing a copy without errors comes to: the counts disagree after the upsert, so it is reloaded."""
    e, cached = _events(spark, d)
    kept = cached.join(e.filter("event_type = 'error'").select("event_id"), "event_id", "left_anti")
    step, rows = R.refresh(kept, e, "event_id", "modified")
    return rows.groupBy("event_type").agg(F.count("*").alias("n")).withColumn("step", F.lit(step))


def refresh_merged(spark, d):
    """Delta, upsert and decision over the copy."""
    e, cached = _events(spark, d)
    step, rows = R.refresh(cached, e, "event_id", "modified")
    return rows.select("event_id", "event_type", "user_id", F.lit(step).alias("step"))


def stream_latest(spark, d):
    """The latest event of every user by a stream: files of mixed times in several micro-batches, so keys repeat and come late."""
    e, _ = _events(spark, d)
    folder = scratch_folder(spark)
    rows = e.select("event_id", "user_id", "event_type", "modified")
    rows.repartition(STREAM_FILES, "event_id").write.parquet(f"{folder}/in")
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", STREAM_FILES // 4).parquet(f"{folder}/in")
    arriving = arriving.withColumn("seq", F.struct("modified", "event_id"))
    refresh_stream(arriving, f"{folder}/layer", "user_id", "seq", "events", "all", f"{folder}/checkpoint", "modified").awaitTermination()
    return Layer(spark, f"{folder}/layer", "events", "all").read().select("user_id", "event_id", "event_type", "modified")


def date_export_query(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("OBJECTID"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("installationdate"), F.when(F.col("o_custkey") % 3 > 0, F.unix_millis(F.col("o_orderdate").cast("timestamp") - F.expr("interval 400 days"))).alias("CREATIONDATE"))
    return date_export(o, "1996-01-01", ["installationdate"]).select("OBJECTID", F.substring("installationdate", 1, 19).alias("installed"), "CREATIONDATE")


FIELDS = {"fields": [{"name": "pipe_oid", "type": "esriFieldTypeOID"}, {"name": "layer", "type": "esriFieldTypeString"}]}


def _pages(spark, d):
    """Pages of the pipes as JSON texts."""
    c = F.col
    p = W.pipes(spark, d)
    path = F.array(F.array(c("x1"), c("y1"), F.lit(7.0)), F.array(c("x1") + c("dx"), c("y1") + c("dy"), F.lit(8.0)))
    stub = F.array(F.array(c("x1"), c("y1")))
    geometry = F.when(c("assettype").isNotNull(), F.struct(F.array(path, stub).alias("paths")))
    feature = F.struct(F.struct("pipe_oid", "layer").alias("attributes"), geometry.alias("geometry"))
    return page_texts(p, "pipe_oid", feature)


def _page_rows(rows):
    paths = F.col("paths")
    return rows.select("pipe_oid", "layer", F.size(paths).cast("long").alias("paths"), paths[0][0]["x"].alias("x"), paths[0][1]["y"].alias("y"))


def feature_pages(spark, d):
    """Pages read back as rows; one-vertex paths and missing geometries go."""
    return _page_rows(features(_pages(spark, d), layer_schema(FIELDS)[0]))


def paged_layer(spark, d):
    """The same pages as a client stepping through offsets sees them, from stored page texts."""
    return _page_rows(fetched_pages(stored(_pages(spark, d)), layer_schema(FIELDS)[0]))


def display_leaks(spark, d):
    return V.display_leaks(W.leaks(spark, d), W.raw_supplemental(spark, d)).select("leak_oid", "JoinLeakKey", "SuppLeakMaterialType", "SuppDiameter", "SuppFacilityType")


def display_pipes(spark, d):
    return E.display_pipes(W.enriched(spark, d))


def filtered_count(spark, d):
    return W.leaks(spark, d).filter("jurisdiction = 'MA'").agg(F.count("*").alias("n"))


def distinct_ids(spark, d):
    return W.pipes(spark, d).select("pipe_oid").distinct()


def stacked_layers(spark, d):
    p = W.pipes(spark, d)
    return p.filter("layer = 'service'").select("pipe_oid", "layer").unionByName(p.filter("layer = 'distribution'").select("pipe_oid", "layer", "nominaldiameter"), allowMissingColumns=True)


def duplicate_ids_last(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return last_row(lines, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"])


def supplemental_last(spark, d):
    return supplemental(W.raw_supplemental(spark, d)).select("leak_key", "leak_diameter", "leak_material")


def watermark_literals(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    ms = (F.col("event_id") % 7 - 3) * F.unix_millis(F.col("ts").cast("timestamp"))
    wide = ms.cast("double")
    return e.select("event_id", epoch_ms(ms).alias("ms"), F.date_format(safe_watermark(ms), "yyyy-MM-dd HH:mm:ss").alias("mark"), epoch_ms(wide).alias("wide_ms"), F.date_format(safe_watermark(wide), "yyyy-MM-dd HH:mm:ss").alias("wide_mark"))


def snapshot_roundtrip(spark, d):
    folder = scratch_folder(spark)
    write_snapshot(W.pipes(spark, d).filter("layer = 'service'"), folder, "pipes", "service", None, None)
    return read_snapshot(spark, folder, "pipes", "service").select("pipe_oid", "nominaldiameter", "x1", "dy")


def csv_roundtrip(spark, d):
    """The supplemental table through a CSV file, where every column is text and blanks are null."""
    folder = scratch_folder(spark)
    write_csv(W.raw_supplemental(spark, d).withColumnRenamed("ordinal", "row_no"), folder)
    return read_supplemental(spark, folder).groupBy("Diameter", "FacilityType", "Pressure", "row_no").agg(F.count("*").alias("n"))


def _relocation(spark, d):
    """The job over leaks with repeated ids; the run's time is a fixed text, so that reruns agree."""
    segments = W.segment_table(spark, d).withColumn("pipe_gid", F.concat(F.lit("{P-"), F.col("pipe_oid").cast("string"), F.lit("}")))
    return J.relocation_job(W.tasks_with_gid(spark, d), segments, ["seen"], F.lit(RUN_UTC))


def job_relocated_leaks(spark, d):
    return _relocation(spark, d)["relocated_leaks"]


def job_offset_lines(spark, d):
    return _relocation(spark, d)["relocated_leak_offset_lines"]


def job_audit(spark, d):
    return _relocation(spark, d)["leak_relocation_audit"]


def enrich_job(spark, d):
    """A dry run counts, a second run skips, a forced one decodes anew."""
    once = W.enriched(spark, d)
    runs = [J.enrich_job(W.coded_pipes(spark, d), W.decoder_table(spark), dry_run=True), J.enrich_job(once, W.decoder_table(spark)), J.enrich_job(once, W.decoder_table(spark), force=True)]
    count = lambda step, df: df.groupBy("ASSETTYPE_DECODED").agg((F.sum("n") if "n" in df.columns else F.count("*")).alias("n")).withColumn("step", F.lit(step))
    parts = [count(step, df) for step, df in runs]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def report_counts(spark, d):
    return J.report_counts(relocated_leaks(spark, d), ["LinkedLayer", "MatchMaterial", "MatchDiameter", "MatchPressure", "SearchRadiusFt"])


def report_rows(spark, d):
    out = J.report_rows(relocated_leaks(spark, d).withColumns({c: F.round(c, 3) for c in ("x", "y")}))
    return out.select("OrigLeakOID", "LinkedLayer", "MatchedPipeOID", "MatchMaterial", "WKT")


def viewport_answer(spark, d):
    return J.viewport_answer(_lines(spark, d), "pipe_oid", BOX, 120.0, ["pipe_oid", "layer"])


def context_export(spark, d):
    return J.context_export(W.leaks(spark, d), "leak_oid", 3500)


def viewer_export(spark, d):
    tasks, found = _matches(spark, d)
    found = stored(found)
    return J.viewer_export(O.relocated_leaks(tasks, found), O.guide_lines(tasks, found), ["OrigLeakOID", "LinkedLayer", "MatchedPipeOID", "SearchRadiusFt"], ["LeakOID", "LinkedLayer", "MatchedPipeOID"])


def _dated_pipes(spark, d):
    """Pipes with the dates of their line; those without a material code have no geometry."""
    dates = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("installationdate"))
    p = W.pipes(spark, d).withColumn("k", F.expr("pipe_oid div 1000 div 100000 div 10")).join(dates, "k")
    v = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    c = F.col
    path = F.array(F.array(v(c("x1"), c("y1")), v(c("x1") + c("dx"), c("y1") + c("dy"))))
    return p.select("pipe_oid", "installationdate", F.when(c("assettype").isNotNull(), path).alias("paths"))


def export_job(spark, d):
    """Both files of the export, read back: the CSV rows with their feature, if they have geometry."""
    folder = scratch_folder(spark)
    J.export_job(_dated_pipes(spark, d), "1996-01-01", folder, ["installationdate"])
    table = spark.read.option("header", True).schema("pipe_oid long, installationdate string").csv(f"{folder}/csv").withColumn("part", F.lit("csv"))
    lines = spark.read.text(f"{folder}/geojson").select(F.get_json_object("value", "$.properties.pipe_oid").cast("long").alias("pipe_oid"), F.get_json_object("value", "$.properties.installationdate").alias("installationdate"), F.concat(F.lit("geojson "), F.get_json_object("value", "$.geometry.coordinates")).alias("part"))
    both = table.unionByName(lines)
    return both.select("pipe_oid", F.substring("installationdate", 1, 19).alias("installed"), "part")


def date_variants(spark, d):
    """Layers that write their dates as milliseconds, as text and as seconds, and one without a date since the day:
    which way is chosen and how many rows pass by it."""
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("OBJECTID"), F.col("o_orderdate").cast("timestamp").alias("t"))
    ways = {"ms": F.unix_millis("t"), "text": F.date_format("t", "yyyy-MM-dd"), "s": F.unix_seconds("t").cast("string"), "none": F.lit(None).cast("string")}
    found = [(layer, *choose_since(o.select("OBJECTID", c.alias("installationdate")), "1996-01-01")[::2]) for layer, c in ways.items()]
    return spark.createDataFrame(found, "layer string, chosen string, n long")


def date_export_text(spark, d):
    """The export of a layer whose dates are text: the first way of reading them finds nothing."""
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("OBJECTID"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("installationdate"), F.col("o_custkey").alias("c"))
    return date_export(o, "1996-01-01").select("OBJECTID", "installationdate", "c")


def paged_source(spark, d):
    """The dated pipes as indexed page files, fetched back through the data source since a day: a task a page, pages of other dates unopened."""
    folder = scratch_folder(spark)
    path = F.transform(F.col("paths"), lambda p: F.transform(p, lambda v: F.array(v["x"], v["y"])))
    feature = F.struct(F.struct("pipe_oid", "installationdate").alias("attributes"), F.when(F.col("paths").isNotNull(), F.struct(path.alias("paths"))).alias("geometry"))
    write_pages(_dated_pipes(spark, d), "installationdate", {"id": "pipe_oid", "date": "installationdate"}, feature, folder)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(IndexedFeatureSource)
    source = spark.read.format("indexed_features").schema("pipe_oid long, installationdate long, geometry string").options(path=folder, idField="pipe_oid", dateField="installationdate").load()
    since = source.filter(F.col("installationdate") >= SINCE_MS)
    return since.select("pipe_oid", "installationdate", F.get_json_object("geometry", "$.paths[0][0][0]").cast("double").alias("x"), F.get_json_object("geometry", "$.paths[0][1][1]").cast("double").alias("y"))


def csv_file_order(spark, d):
    """Of the rows of a customer in several CSV files the last counts: the last line of the last file that has one."""
    folder = scratch_folder(spark)
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("LeakNumber"), F.col("o_orderkey").alias("line"), (F.col("o_orderkey") % 7).alias("file"))
    write_csv(o.repartitionByRange(7, "file", "line").sortWithinPartitions("file", "line"), folder)
    last = last_row(read_supplemental(spark, folder), "LeakNumber", ["ordinal"])
    return last.select(F.col("LeakNumber").cast("long").alias("custkey"), F.col("file").cast("long").alias("file"), F.col("line").cast("long").alias("line"))


def clustered_view(spark, d):
    """A stored pipe layer with its display columns, laid out for views; a view of it that the cap really cuts."""
    folder = scratch_folder(spark)
    en = E.enrich_pipes(W.coded_pipes(spark, d).dropDuplicates(["pipe_oid"]), W.decoder_table(spark)).withColumn("paths", F.when(F.col("ASSETTYPE").isNotNull(), F.expr(PIPE_PATHS)))
    lines = E.display_pipes(en, ("paths",)).select("pipe_oid", "PipeMaterialFamily", "PipeMaterialColor", "paths")
    write_clustered(lines, folder, file_rows=4096)
    return J.viewport_answer(lines_near_view(spark, folder, *BOX), "pipe_oid", BOX, 120.0, ["pipe_oid", "PipeMaterialFamily", "PipeMaterialColor"], cap=400)


def export_count(spark, d):
    return J.export_job(_dated_pipes(spark, d), "1996-01-01", "", count_only=True)


def refresh_job(spark, d):
    """Store the first nine tenths of the events' time, all types old; then bring that layer up to date."""
    e, old = _events(spark, d)
    folder = scratch_folder(spark)
    J.refresh_job(spark, folder, old, "event_id", "modified", "events", "all")
    step, rows = J.refresh_job(spark, folder, e, "event_id", "modified", "events", "all", fresh_seconds=-1)
    return rows.select("event_id", "event_type", "user_id", F.lit(step).alias("step"))


QUERIES = {
    "clean_keys": clean_keys,
    "parse_numbers": parse_numbers,
    "decode_material": decode_material,
    "family_match": family_match,
    "family_row": family_row,
    "family_viewer": family_viewer,
    "route_layers": route_layers_query,
    "search_ring": search_ring_query,
    "supplement_leaks": supplement_leaks,
    "supplemental_last": supplemental_last,
    "leak_gate_counts": leak_gate_counts,
    "prepare_pipes_counts": prepare_pipes_counts,
    "enrich_pipes": enrich_pipes,
    "decode_counts": decode_counts,
    "preflight_profile": preflight_profile,
    "family_collapse": family_collapse,
    "relocated_leaks": relocated_leaks,
    "relocated_leaks_strict": relocated_leaks_strict,
    "guide_lines": guide_lines,
    "relocation_audit": relocation_audit,
    "run_counters": run_counters,
    "audit_agreement": audit_agreement,
    "audit_disagreements": audit_disagreements,
    "distance_describe": distance_describe,
    "value_counts": value_counts,
    "family_impact": family_impact,
    "affected_rows": affected_rows,
    "impact_share": impact_share,
    "wanted_rows": wanted_rows,
    "relocated_sample": relocated_sample,
    "layer_bounds": layer_bounds,
    "viewport_points": viewport_points,
    "viewport_lines": viewport_lines,
    "layer_sample": layer_sample,
    "table_page": table_page,
    "reproject_points": reproject_points,
    "simplify_lines": simplify_lines,
    "line_centroids": line_centroids,
    "geojson_features": geojson_features,
    "wkt_export": wkt_export,
    "upsert_layer": upsert_layer,
    "delta_rows": delta_rows,
    "refresh_watermark": refresh_watermark,
    "refresh_watermark_all": refresh_watermark_all,
    "refresh_decision": refresh_decision,
    "refresh_merged": refresh_merged,
    "watermark_literals": watermark_literals,
    "date_export": date_export_query,
    "feature_pages": feature_pages,
    "display_leaks": display_leaks,
    "display_pipes": display_pipes,
    "filtered_count": filtered_count,
    "distinct_ids": distinct_ids,
    "stacked_layers": stacked_layers,
    "duplicate_ids_last": duplicate_ids_last,
    "snapshot_roundtrip": snapshot_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "paged_layer": paged_layer,
    "job_relocated_leaks": job_relocated_leaks,
    "job_offset_lines": job_offset_lines,
    "job_audit": job_audit,
    "enrich_job": enrich_job,
    "report_counts": report_counts,
    "report_rows": report_rows,
    "viewport_answer": viewport_answer,
    "context_export": context_export,
    "viewer_export": viewer_export,
    "export_job": export_job,
    "export_count": export_count,
    "refresh_job": refresh_job,
    "stream_latest": stream_latest,
    "date_variants": date_variants,
    "date_export_text": date_export_text,
    "csv_file_order": csv_file_order,
    "paged_source": paged_source,
    "simplify_networks": simplify_networks,
    "two_systems": two_systems,
    "clustered_view": clustered_view,
}
