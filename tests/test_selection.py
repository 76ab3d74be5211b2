"""Exact percentiles by rank selection, views of clustered layers, file order of CSV rows, ways of writing dates."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayside.operators import enrich as E
from wayside.operators.clustered import files_in_view, lines_near_view, write_clustered
from wayside.operators.export import choose_since, date_export
from wayside.operators.prepare import last_row, supplemental
from wayside.sources.feature_source import IndexedFeatureSource, shared_out, write_pages
from wayside.sources.pages import read_supplemental


@pytest.mark.parametrize("kind", ["spread", "ties", "outlier", "one", "two", "tiny"])
def test_percentiles(spark, kind):
    rng = random.Random(3)
    values = {
        "spread": [rng.gauss(0, 50) for _ in range(3000)], "ties": [float(rng.randrange(5)) for _ in range(500)] + [2.5] * 900, "outlier": [rng.random() for _ in range(400)] + [1e300, -1e300],
        "one": [4.5], "two": [1.0, 2.0], "tiny": [1.0 + k * 2.0**-52 for k in range(50)],
    }[kind]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    got = E.describe(df, "v").first()
    assert got.n == len(values) and (got.low, got.high) == (min(values), max(values))
    wanted = [float(np.quantile(np.array(values), p)) for p in (0.5, 0.75, 0.9, 0.95, 0.99)]
    assert list(got[5:]) == pytest.approx(wanted, rel=1e-12)


def test_percentiles_of_nothing(spark):
    got = E.describe(spark.createDataFrame([(None,)], "v double"), "v").first()
    assert got.n == 0 and list(got[1:]) == [None] * 9


def test_no_task_gathers_the_values(spark):
    """The widest exchange holds counted parts, not values."""
    df = spark.range(50000).select((F.col("id") * 0.37).alias("v")).repartition(4)
    found = E.percentiles(df, "v", [0.5], 50000, 0.0, 49999 * 0.37)
    assert found == pytest.approx([np.quantile(np.arange(50000) * 0.37, 0.5)])


def line(x, y, w, h):
    return [[(float(x), float(y)), (float(x + w), float(y + h))]]


def test_a_view_opens_few_files(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, line(rng.uniform(0, 1000), rng.uniform(0, 1000), rng.uniform(-9, 9), rng.uniform(-9, 9))) for i in range(4000)]
    rows += [(9001, None), (9002, []), (9003, [[(float("nan"), 1.0), (2.0, 2.0)]]), (9004, line(400, 400, 500, 500))]
    df = spark.createDataFrame(rows, "id long, paths array<array<struct<x:double,y:double>>>")
    folder = f"file://{tmp_path}/layer"
    write_clustered(df, folder, file_rows=50)
    every = spark.read.parquet(f"{folder}/index")
    assert every.count() >= 60 and every.agg(F.sum("n")).first()[0] == 4001
    box = (500.0, 500.0, 560.0, 540.0)
    got = lines_near_view(spark, folder, *box)
    opened = files_in_view(spark, folder, *box)
    assert len(opened) <= every.count() / 8 and {f.rsplit("/", 1)[1] for f in got.inputFiles()} <= {f.rsplit("/", 1)[1] for f in opened}
    meets = lambda p: min(x for x, _ in p[0]) <= 560 and max(x for x, _ in p[0]) >= 500 and min(y for _, y in p[0]) <= 540 and max(y for _, y in p[0]) >= 500
    assert {r.id for r in got.collect()} == {i for i, p in rows if p and i != 9003 and meets(p)} and got.columns == ["id", "paths"]
    assert lines_near_view(spark, folder, 5000.0, 5000.0, 5001.0, 5001.0).count() == 0
    plan = got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "LessThanOrEqual(west,560.0)" in plan  # reaches the row groups


def test_rows_count_in_the_order_of_the_files(spark, tmp_path):
    """Several files, one of several blocks; the last line of the last file wins."""
    wanted = {}
    for f in range(3):
        with open(tmp_path / f"s-{f}.csv", "w", encoding="utf-8") as out:
            out.write("﻿LeakNumber,Diameter\n")
            for i in range(3000 if f == 1 else 20):
                key, value = f"K{(i * 7 + f) % 50}", f"{f}-{i:06d}-{'x' * 40}"
                out.write(f"{key},{value}\n")
                wanted[key] = value
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16384)
    try:
        raw = read_supplemental(spark, f"{tmp_path}/s-*.csv")
        assert raw.rdd.getNumPartitions() > 5
        got = {r.LeakNumber: r.Diameter for r in last_row(raw, "LeakNumber", ["ordinal"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == wanted


def test_dates_in_whatever_way(spark):
    table = lambda kind, *v: spark.createDataFrame([(i, x) for i, x in enumerate(v)], f"OBJECTID long, installationdate {kind}")
    assert choose_since(table("long", 1640995200000, 1000, None), "2022-01-01")[::2] == ("milliseconds", 1)
    assert choose_since(table("string", "2022-01-01", "2021-12-31", "x", None), "2022-01-01")[::2] == ("text", 1)
    assert choose_since(table("long", 1640995200, 1640995199), "2022-01-01")[::2] == ("seconds", 1)
    assert choose_since(table("string", "", None), "2022-01-01")[::2] == ("milliseconds", 0)
    assert choose_since(table("string"), "2022-01-01")[::2] == ("milliseconds", 0)
    assert [r.OBJECTID for r in date_export(table("string", "2021-12-31", "2022-05-01"), "2022-01-01").collect()] == [1]


def test_only_the_pages_in_range_are_opened_each_once(spark, tmp_path):
    rows = spark.range(5000).select(F.col("id").alias("OBJECTID"), (F.col("id") * 1000).alias("day"))
    feature = F.struct(F.struct("OBJECTID", "day").alias("attributes"), F.when(F.col("OBJECTID") % 10 > 0, F.struct(F.lit(1.0).alias("x"))).alias("geometry"))
    write_pages(rows, "OBJECTID", {"id": "OBJECTID", "date": "day"}, feature, f"file://{tmp_path}/l", size=100)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(IndexedFeatureSource)
    load = lambda **o: spark.read.format("indexed_features").schema("OBJECTID long, day long, geometry string, page_number int").options(path=f"file://{tmp_path}/l", dateField="day", **o).load()
    every = load()
    assert every.count() == 4500 and 45 <= every.rdd.getNumPartitions() <= 50
    for test, wanted in (("OBJECTID between 1000 and 1250", 225), ("day > 4900000", 90), ("OBJECTID = 77", 1), ("OBJECTID in (5, 4001, null)", 2), ("OBJECTID >= 9000", 0), ("OBJECTID < 100 and day >= 50000", 45)):
        some = load().filter(test)
        assert some.count() == wanted and len(some.select("OBJECTID").distinct().collect()) == wanted
        assert some.rdd.getNumPartitions() <= 6, test  # a task is a page
    some = load(ids="1,11,x,4999,20")
    assert sorted(r.OBJECTID for r in some.collect()) == [1, 11, 4999] and some.rdd.getNumPartitions() <= 3


def test_a_value_of_many_rows_fills_several_pages(spark, tmp_path):
    rows = spark.range(3000).select(F.col("id").alias("OBJECTID"), F.when(F.col("id") < 2000, 7).when(F.col("id") < 2900, F.col("id")).cast("long").alias("day"))
    feature = F.struct(F.struct("OBJECTID", "day").alias("attributes"), F.struct(F.lit(1.0).alias("x")).alias("geometry"))
    write_pages(rows, "day", {"id": "OBJECTID", "date": "day"}, feature, f"file://{tmp_path}/l", size=100)
    index = sorted(spark.read.json(f"file://{tmp_path}/l/index").collect(), key=lambda r: r.page)
    assert [r.page for r in index] == list(range(30)) and sum(r.n for r in index) == 3000 and max(r.n for r in index) < 200
    assert [r.n for r in index if (r.first_date or 0) > 7] == [100] * 9  # pages of rare values are as long as wanted
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(IndexedFeatureSource)
    read = spark.read.format("indexed_features").schema("OBJECTID long, day long, page_number int").options(path=f"file://{tmp_path}/l", dateField="day").load()
    assert sorted(r.OBJECTID for r in read.collect()) == list(range(3000))
    assert read.filter("day = 7").count() == 2000 and read.filter("day = 7").rdd.getNumPartitions() <= 22
    assert [len(p.pages) for p in shared_out([(i, "") for i in range(5000)])] == [3] * 1666 + [2] and shared_out([]) == []


def test_supplemental_shuffles_texts_alone_and_makes_its_key_once(spark):
    """The last row of a key is found before materials and numbers are told; the filter on keys does not make them again."""
    rows = [("lk-1", 0, "2 in", "CI", "Main", "LP"), ("{LK-1}", 1, "4", "9", " Service ", None), (None, 0, "1", "x", "", ""), ("7.0", 0, None, None, "Main", "hp")]
    raw = spark.createDataFrame(rows, "LeakNumber string, ordinal int, Diameter string, LeakMaterialType string, FacilityType string, Pressure string")
    out = supplemental(raw)
    got = {r.leak_key: (r.leak_diameter, r.leak_material, r.leak_pressure, r.facility) for r in out.collect()}
    assert got == {"LK-1": (4.0, "Plastic PE", "", "Service"), "7": (None, "", "hp", "Main")}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window [") : plan.index("Generate explode")]
    assert "regexp" not in below and "material#" not in below and "family#" not in below
