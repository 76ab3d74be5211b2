"""Resolution, enrichment, audits, refresh, sources and streaming on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from wayside.operators import enrich as E
from wayside.operators import refresh as R
from wayside.operators import resolve as S
from wayside.operators.export import date_export, date_fields
from wayside.sources.feature_source import FeatureSource, fetch
from wayside.functions.text import json_safe
from wayside.operators.enrich import attach_attributes
from wayside.sources.pages import features, layer_schema, page_texts, read_snapshot, read_supplemental, snapshot_meta, write_snapshot
from wayside.streaming.refresh_stream import refresh_stream


def test_resolve():
    assert S.resolve(["Leak_Number", "NAME"], S.CANDIDATES["leak_key"]) == "Leak_Number"
    assert S.resolve(["a-b", "AB"], ["ab"]) == "AB"
    assert S.resolve(["x"], ["y"]) is None
    with pytest.raises(KeyError, match="leak key"):
        S.resolve(["x"], ["y"], "leak key")
    assert S.resolve_loosely(["Pipe_Diameter", "DIAMETER"], ["diameter"]) == "DIAMETER"
    assert S.resolve_loosely(["Leak Material Type 2"], ["LeakMaterialType"]) == "Leak Material Type 2"
    assert S.download_columns(["OBJECTID", "GlobalID", "LASTUPDATE", "nominaldiameter", "material", "ASSETGROUP", "ASSETTYPE"], "pipe", "OBJECTID") == ["OBJECTID", "LASTUPDATE", "nominaldiameter", "material", "GlobalID", "ASSETGROUP", "ASSETTYPE"]
    assert S.download_columns(["OBJECTID"], "leak", "OBJECTID") == ["*"]
    assert S.display_columns(["foo", "leak_id", "geometry"]) == ["leak_id", "geometry"] and S.display_columns(["foo", "geometry"]) == ["geometry", "foo"]
    assert S.pick_table(["a", "relocated_x"], ["relocated_leaks"], ["relocated"]) == "relocated_x"
    with pytest.raises(RuntimeError, match="No curated field"):
        S.curated_columns(["zzz"], ["material"])


METADATA = {
    "typeIdField": "ASSETGROUP",
    "types": [
        {"id": 1, "name": "Main", "domains": {"AssetType": {"name": "Mat", "codedValues": [{"code": 5, "name": "Copper"}, {"code": 1.0, "name": "Bare Steel"}]}}},
        {"id": 2, "name": "None", "domains": {"OTHER": {"name": "x", "codedValues": []}}},
    ],
}


def test_enrichment(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps(METADATA))
    dec = E.decoder(E.read_metadata(spark, str(tmp_path / "m.json")))
    assert {(r.group_code, r.type_code, r.PipeMaterialFamily) for r in dec.collect()} == {("1", "5", "COPPER"), ("1", "1", "STEEL")}
    pipes = spark.createDataFrame([(1, "G1", 1.0, 5.0), (2, "G2", 1.0, None), (3, "G3", 9.0, 5.0)], "OBJECTID long, material string, ASSETGROUP double, ASSETTYPE double")
    once = E.enrich_pipes(pipes, dec)
    twice = E.enrich_pipes(once, dec)
    assert sorted(map(str, once.select(sorted(once.columns)).collect())) == sorted(map(str, twice.select(sorted(once.columns)).collect()))
    rows = {r.OBJECTID: r for r in once.collect()}
    assert (rows[1].material, rows[1].GradeMaterial, rows[1].PipeMaterialRaw) == ("Copper", "G1", 5.0) and rows[3].material is None and rows[2].GradeMaterial == "G2"
    assert E.preflight(once, ["ASSETTYPE", "ASSETTYPE_DECODED"]) == "PASS" and E.preflight(pipes, []) == "NOT ENRICHED"
    assert E.preflight(once.withColumn("ASSETTYPE", F.lit(None).cast("double")), ["ASSETTYPE"]) == "ENRICHED BUT EMPTY"
    assert E.collapsed(once).first().collapsed and E.already_enriched(once) and not E.already_enriched(pipes)
    assert {(r.value, r.family_before, r.family_after) for r in E.family_impact(once, "material").collect()} == {("Copper", "PLASTIC", "COPPER")}
    attrs = spark.createDataFrame([(1, 7), (1, 7)], "OBJECTID long, extra int")
    assert E.attach_attributes(pipes, attrs).count() == 3


def test_refresh(spark):
    assert R.decide(10, 3600, 5, None, None) == "cache" and R.decide(None, 3600, None, 5, 1) == "reload"
    assert R.decide(9999, 3600, 5, 5, 0) == "cache" and R.decide(9999, 3600, 5, 6, 0) == "reload" and R.decide(None, 3600, 5, 6, 1) == "upsert"
    cached = spark.createDataFrame([(1, 1000, "a"), (2, 2000, "b")], "id long, m long, v string")
    source = spark.createDataFrame([(1, 1000, "a"), (2, 9000, "c"), (3, 9500, "d")], "id long, m long, v string")
    step, rows = R.refresh(cached, source, "id", "m")
    assert step == "upsert" and sorted(r.v for r in rows.collect()) == ["a", "c", "d"]
    step, rows = R.refresh(cached, source.filter("id <> 1"), "id", "m")
    assert step == "reload" and rows.count() == 2
    assert R.refresh(cached, source, "id", "m", age_seconds=5)[0] == "cache"
    assert R.watermark(cached.limit(0), "m").first().watermark.year == 1970


def test_snapshots_and_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    folder = str(tmp_path / "snap")
    assert read_snapshot(spark, folder, "u", "w") is None
    write_snapshot(df, folder, "u", "w", "m", 5)
    assert read_snapshot(spark, folder, "u", "w").count() == 2 and read_snapshot(spark, folder, "u2", "w") is None and snapshot_meta(spark, folder)["n"] == 2
    (tmp_path / "in").mkdir()
    changes = spark.createDataFrame([(2, "c", 1), (3, "d", 1), (3, "e", 2)], "id long, v string, seq int")
    changes.write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(changes.schema).parquet(str(tmp_path / "in"))
    refresh_stream(stream, folder, "id", "seq", "u", "w", str(tmp_path / "cp")).awaitTermination(120)
    assert sorted((r.id, r.v) for r in read_snapshot(spark, folder, "u", "w").collect()) == [(1, "a"), (2, "c"), (3, "e")]


def test_pages_and_source(spark, tmp_path):
    meta = {"fields": [{"name": "OBJECTID", "type": "esriFieldTypeOID"}, {"name": "v", "type": "esriFieldTypeString"}, {"name": "SHAPE", "type": "esriFieldTypeGeometry"}], "maxRecordCount": 500, "extent": {"spatialReference": {"wkid": 1, "latestWkid": 2}}}
    schema, oid, wkid, page = layer_schema(meta)
    assert (oid, wkid, page) == ("OBJECTID", 2, 500) and schema.fieldNames() == ["OBJECTID", "v"]
    pages = tmp_path / "pages"
    pages.mkdir()
    for k in range(3):
        rows = [{"attributes": {"OBJECTID": 10 * k + i, "v": f"x{i}"}, "geometry": None if i == 0 else {"x": 1.0 * i, "y": 2.0}} for i in range(4)]
        (pages / f"page-{k}.json").write_text(json.dumps({"features": rows}))
    got = features(spark.read.text(str(pages), wholetext=True), schema)
    assert got.count() == 9
    spark.dataSource.register(FeatureSource)
    ddl = "OBJECTID long, v string, geometry string"
    table = spark.read.format("features").schema(ddl).option("path", str(pages)).load()
    assert sorted(r.OBJECTID for r in table.collect()) == sorted(r.OBJECTID for r in got.collect())
    some = spark.read.format("features").schema(ddl).option("path", str(pages)).option("ids", "1,11,x,13,20").option("batch", 2).load()
    assert sorted(r.OBJECTID for r in some.collect()) == [1, 11, 13]
    with pytest.raises(OSError):
        fetch(str(pages / "absent.json"), delays=())


def test_supplemental_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("﻿LeakNumber,Diameter\nA1,NA\nA2,\n", encoding="utf-8")
    rows = read_supplemental(spark, str(tmp_path / "s.csv")).collect()
    assert [(r.LeakNumber, r.Diameter) for r in rows] == [("A1", "NA"), ("A2", None)]
    with pytest.raises(KeyError):
        read_supplemental(spark, str(tmp_path / "s.csv"), "Other")


def test_date_export(spark):
    assert date_fields(["inservicedate", "created_date"]) == ("inservicedate", "created_date") and date_fields(["CREATIONDATE"]) == (None, "CREATIONDATE")
    with pytest.raises(RuntimeError, match="some_other_date"):
        date_fields(["some_other_date"])
    df = spark.createDataFrame([(1, 1640995200000, None), (2, 1000, 1640995200000), (3, 1000, 1000)], "OBJECTID long, installationdate long, CREATIONDATE long")
    assert sorted(r.OBJECTID for r in date_export(df, "2022-01-01", ["installationdate"]).collect()) == [1, 2]


def test_pages_are_bounded(spark):
    for n in (0, 50, 5000, 20000):
        pages = page_texts(spark.range(n), "id", F.struct("id"), 100).select(F.size(F.from_json("value", "features array<struct<id long>>")["features"]).alias("n")).collect()
        assert sum(r.n for r in pages) == n and len(pages) == -(-n // 100)
        assert max((r.n for r in pages), default=0) <= 160


def test_first_attribute_row_and_json_safe(spark):
    pipes = spark.createDataFrame([(1,), (2,)], "OBJECTID long")
    attributes = spark.createDataFrame([(1, "b", 2), (1, "c", 1), (2, None, 3)], "OBJECTID long, v string, row int")
    assert sorted((r.OBJECTID, r.v) for r in attach_attributes(pipes, attributes, order=("row",)).collect()) == [(1, "c"), (2, None)]
    row = json_safe(spark.sql("select timestamp'2021-01-02 03:04:05' as t, date'2021-01-02' as d, double('NaN') as n, 2.5D as x, true as b, array(1, 2) as a, 'é' as s")).first()
    assert tuple(row) == ("2021-01-02T03:04:05.000000", "2021-01-02", None, 2.5, True, "[1,2]", "é")


def test_snapshots_keep_the_last_complete_version(spark, tmp_path):
    folder = f"{tmp_path}/s"
    for n in (3, 5, 4):
        write_snapshot(spark.range(n).select("id"), folder, "u", "w", None, None)
        assert read_snapshot(spark, folder, "u", "w").count() == n
    assert snapshot_meta(spark, folder)["turn"] == 2
    spark.range(9).write.parquet(f"{folder}/v-half")  # a version that no row names yet
    assert read_snapshot(spark, folder, "u", "w").count() == 4


def test_wanted_rows_and_impact_share(spark):
    fetched = spark.createDataFrame([("1", "a"), (" 2 ", "b"), ("2.5", "c"), ("x", "d"), (None, "e"), ("99999999999999999999", "f"), ("1", "a")], "OBJECTID string, v string")
    wanted = spark.createDataFrame([(1,), (2,), (2,), (None,)], "OBJECTID long")
    assert sorted(tuple(r) for r in E.wanted_rows(fetched, wanted, "OBJECTID").collect()) == [(1, "a"), (1, "a"), (2, "b")]
    assert E.wanted_rows(fetched, wanted.limit(0), "OBJECTID").count() == 0
    table = spark.createDataFrame([("Copper",), ("Copper",), ("Steel",), (None,)], "m string")
    assert tuple(E.impact_share(table, "m").first()) == (4, 1, 2, 50.0)
    assert tuple(E.impact_share(table.limit(0), "m").first()) == (0, 0, 0, 0.0)
    assert [r.v for r in E.first_rows(fetched, ["v"], 2).collect()] == ["a", "a"]


def test_pages_end_at_the_first_short_one(spark):
    from wayside.sources.pages import fetched_pages, layer_schema

    page = lambda oids, more: json.dumps({"features": [{"attributes": {"OBJECTID": i}, "geometry": {"x": 1.0, "y": 2.0}} for i in oids], **({"exceededTransferLimit": True} if more else {})})
    schema = layer_schema({"fields": [{"name": "OBJECTID", "type": "esriFieldTypeOID"}]})[0]
    got = lambda *pages: sorted(r.OBJECTID for r in fetched_pages(spark.createDataFrame([(2 * i, p) for i, p in enumerate(pages)], "offset long, value string"), schema, 2).collect())
    assert got(page([1, 2], False), page([3], True), page([4], False), page([5, 6], False)) == [1, 2, 3, 4]
    assert got(page([1, 2], False), page([3, 4], False)) == [1, 2, 3, 4]
    assert got(page([], False), page([3, 4], False)) == []


def test_refresh_job_keeps_changes_or_reloads(spark, tmp_path):
    from wayside.operators.jobs import refresh_job

    rows = lambda *r: spark.createDataFrame(list(r), "id long, modified long, v string")
    run = lambda source, **o: refresh_job(spark, f"file://{tmp_path}/layer", source, "id", "modified", "u", "w", **o)
    values = lambda df: sorted((r.id, r.v) for r in df.collect())
    one, two = rows((1, 1000, "a"), (2, 2000, "b")), rows((1, 1000, "a"), (2, 9000, "c"), (3, 9000, "d"))
    assert run(one)[0] == "reload"
    assert run(two)[0] == "cache"  # still fresh
    step, out = run(two, fresh_seconds=-1)
    assert (step, values(out)) == ("upsert", [(1, "a"), (2, "c"), (3, "d")])
    step, out = run(rows((3, 9000, "d")), fresh_seconds=-1)  # deletions show as counts
    assert (step, values(out)) == ("reload", [(3, "d")])


def test_pipes_are_decoded_where_they_are(spark):
    """Pipes are not shuffled by their few codes to be decoded."""
    dec = spark.createDataFrame([("1", "2", "Main", "Cast Iron", "Material", "IRON")], "group_code string, type_code string, ASSETGROUP_DECODED string, ASSETTYPE_DECODED string, ASSETTYPE_DOMAIN string, PipeMaterialFamily string")
    out = E.enrich_pipes(spark.range(3).selectExpr("id as pipe_oid", "1.0 as ASSETGROUP", "id as ASSETTYPE"), dec)
    assert {r.pipe_oid: r.material for r in out.collect()} == {0: None, 1: None, 2: "Cast Iron"}
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
