"""Stored layers: buckets, change files, the manifest, stops between writes, and the exactly-once stream."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from wayside.operators.jobs import refresh_job
from wayside.operators.refresh import delta_since
from wayside.sources.snapshots import Layer, Version
from wayside.streaming.refresh_stream import apply_batch, refresh_stream, stream_identity

SCHEMA = "id long, v string, m long"


def rows(spark, *r):
    return spark.createDataFrame(list(r), SCHEMA)


def values(layer):
    return sorted(((r.id, r.v, r.m) for r in layer.read().collect()), key=str)


@pytest.fixture
def layer(spark, tmp_path):
    return Layer(spark, f"{tmp_path}/layer", "u", "w", bucket_rows=10, most_changes=3)


def first(spark):
    return spark.range(100).select("id", F.lit("old").alias("v"), (F.col("id") * 1000).alias("m"))


def version(layer):
    return Version.of(layer.meta()["version"])


def files(layer):
    return {os.path.join(d, f) for d, _, names in os.walk(layer.folder) for f in names if f.endswith(".parquet")}


def test_changes_are_merged_on_reading(spark, layer):
    assert layer.read() is None
    layer.store(first(spark), "id", "m", source_count=100)
    meta = layer.meta()
    assert (meta["n"], meta["max_modified_ms"], meta["source_count"], meta["turn"]) == (100, 99000, 100, 0) and version(layer).buckets == 10
    before = files(layer)
    assert layer.upsert(rows(spark, (7, "new", 200000), (500, "added", 150000), (None, "keyless", 1)), "id", "m", 102)
    wanted = {i: "old" for i in range(100)} | {7: "new", 500: "added", None: "keyless"}
    assert {r.id: r.v for r in layer.read().collect()} == wanted
    assert (layer.meta()["n"], layer.meta()["max_modified_ms"]) == (102, 200000)
    assert before < files(layer)  # nothing was rewritten
    touched = set(version(layer).changes[0].buckets)
    assert layer.touched(rows(spark, (7, "x", 1), (500, "y", 1)), "id") <= touched and len(touched) <= 3
    layer.compact()
    v = version(layer)
    assert not v.changes and set(v.base[0].buckets).isdisjoint(touched) and set(v.base[1].buckets) == touched
    assert {r.id: r.v for r in layer.read().collect()} == wanted and layer.meta()["n"] == 102
    layer.upsert(rows(spark, (None, "second", 2), (7, "newer", 3)), "id", "m")
    assert sorted(r.v for r in layer.read().filter("id is null or id = 7").collect()) == ["keyless", "newer", "second"]


def test_many_changes_are_compacted(spark, layer):
    layer.store(first(spark), "id", "m")
    for i in range(6):
        layer.upsert(rows(spark, (i, f"c{i}", 10**6 + i), (50, f"c{i}", 10**6 + i)), "id", "m")
        assert len(version(layer).changes) <= 3
    got = {r.id: r.v for r in layer.read().collect()}
    assert len(got) == 100 == layer.meta()["n"] and [got[i] for i in (0, 3, 5, 50, 60)] == ["c0", "c3", "c5", "c5", "old"]


def test_columns_may_differ_and_keys_are_text(spark, layer):
    layer.store(spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string"), "id")
    layer.upsert(spark.createDataFrame([(2, 5)], "id long, extra long").select(F.col("id").cast("string").alias("id"), "extra"), "id")
    assert sorted(((r.id, r.v, r.extra) for r in layer.read().collect()), key=str) == [("1", "a", None), ("2", None, 5)]
    layer.upsert(spark.createDataFrame([("1", "z")], "id string, v string"), "v")  # by another key: dealt anew
    assert version(layer).key == "v" and layer.read().count() == 3


def test_a_stop_between_any_two_writes_leaves_the_version_before(spark, layer, monkeypatch):
    layer.store(first(spark), "id", "m", source_count=100)
    before, meta = values(layer), layer.meta()
    steps = []
    for name in ("_write", "_marked", "_commit", "compacted"):
        whole = getattr(Layer, name)
        for late in (False, True):
            if name == "_commit" and late:
                continue

            def stop(self, *a, whole=whole, late=late, name=name, **k):
                if late:
                    whole(self, *a, **k)
                steps.append(name)
                raise InterruptedError

            with monkeypatch.context() as m:
                m.setattr(Layer, name, stop)
                with pytest.raises(InterruptedError):
                    Layer(spark, layer.folder, "u", "w", 10, 0).upsert(rows(spark, (3, "half", 10**7)), "id", "m")
            assert values(layer) == before and layer.meta()["turn"] == meta["turn"]
    assert len(steps) == 7
    layer.upsert(rows(spark, (3, "whole", 10**7)), "id", "m")
    assert [r.v for r in layer.read().filter("id = 3").collect()] == ["whole"]


def test_unexpected_counts_change_nothing(spark, layer):
    layer.store(first(spark), "id", "m")
    before = values(layer)
    assert not layer.upsert(rows(spark, (3, "x", 10**7)), "id", "m", expected=101)
    assert values(layer) == before and layer.meta()["turn"] == 0


def test_refresh_takes_its_mark_from_the_manifest(spark, tmp_path):
    folder = f"{tmp_path}/layer"
    run = lambda source, **o: refresh_job(spark, folder, source, "id", "m", "u", "w", **o)
    one = rows(spark, (1, "a", 1500), (2, "b", 2000))
    assert run(one)[0] == "reload" and run(one)[0] == "cache"
    assert run(one, fresh_seconds=-1)[0] == "cache"
    step, out = run(rows(spark, (1, "a", 1500), (2, "c", 3800), (3, "d", 9000)), fresh_seconds=-1)
    assert step == "upsert" and sorted(r.v for r in out.collect()) == ["a", "c", "d"]
    meta = Layer(spark, folder, "u", "w").meta()
    assert (meta["max_modified_ms"], meta["source_count"], meta["n"]) == (9000, 3, 3)
    assert run(rows(spark, (3, "d", 9000)), fresh_seconds=-1)[0] == "reload"
    assert Layer(spark, folder, "u", "w").meta()["max_modified_ms"] == 9000
    assert refresh_job(spark, folder, one, "id", None, "u", "w", fresh_seconds=-1)[0] == "reload"
    assert refresh_job(spark, folder, one, "id", None, "u", "w", fresh_seconds=-1)[0] == "cache"
    assert refresh_job(spark, folder, one, "id", "m", "other", "w")[0] == "reload"


def test_delta_of_whole_numbers_reaches_the_scan(spark, tmp_path):
    first(spark).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    plan = delta_since(t, "m", 5999)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(m,5000)" in plan
    assert delta_since(t, "m", 5999).count() == 94
    assert delta_since(t.select(F.col("m").cast("string").alias("m")), "m", 5999).count() == 94
    for mark in (None, -1, 10**15):
        assert delta_since(t, "m", mark).count() == 99  # from 1970 on, strictly


def changes(spark, n=60):
    t = spark.range(n).select((F.col("id") % 7).alias("id"), F.concat(F.lit("v"), "id").alias("v"), ((F.col("id") * 37) % 61 * 1000).alias("m"))
    return t.withColumn("id", F.when(F.col("v") != "v5", F.col("id")))


def latest(spark):
    out = {}
    for r in changes(spark).collect():
        if r.id is not None and (r.id not in out or out[r.id][1] < r.m):
            out[r.id] = (r.v, r.m)
    return sorted([(k, *v) for k, v in out.items()] + [(r.id, r.v, r.m) for r in changes(spark).collect() if r.id is None], key=str)


def test_stream_in_several_batches_and_restarts(spark, tmp_path):
    folder, inbox, checkpoint = f"{tmp_path}/layer", f"{tmp_path}/in", f"{tmp_path}/cp"
    changes(spark).repartition(6).write.parquet(inbox)

    def run():
        arriving = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(inbox)
        refresh_stream(arriving, folder, "id", "m", "u", "w", checkpoint).awaitTermination()
        return Layer(spark, folder, "u", "w")

    layer = run()
    assert values(layer) == latest(spark)
    meta = layer.meta()
    assert meta["batch_id"] == 2 and meta["turn"] == 2 and meta["max_modified_ms"] == max(r.m for r in changes(spark).collect())
    # stopped after the layer's version and before the stream's own note of batch 2
    for name in ("2", ".2.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    assert run().meta()["turn"] == 2 and values(layer) == latest(spark)
    # stopped before the version: the batch is run
    shutil.rmtree(folder + "/manifest")
    shutil.rmtree(checkpoint)
    assert values(run()) == latest(spark)


def test_a_batch_that_is_run_again_is_left_out(spark, layer):
    one, two = rows(spark, (1, "a", 10), (1, "b", 20), (2, "c", 5)), rows(spark, (1, "late", 15), (2, "d", 6), (2, "e", 5), (3, "f", None), (2, "null", None))
    assert apply_batch(layer, one, 0, "s", "id", "m", "m") and not apply_batch(layer, one, 0, "s", "id", "m", "m")
    assert apply_batch(layer, two, 1, "s", "id", "m", "m") and not apply_batch(layer, two, 1, "s", "id", "m", "m")
    assert values(layer) == [(1, "b", 20), (2, "d", 6), (3, "f", None)]
    assert apply_batch(layer, rows(spark, (2, "equal", 6)), 0, "another stream", "id", "m", "m")
    assert values(layer)[1] == (2, "equal", 6)
    with pytest.raises(ValueError, match="another url"):
        apply_batch(Layer(spark, layer.folder, "u2", "w"), one, 0, "s", "id", "m", "m")


def test_identity_is_the_checkpoints(spark, tmp_path):
    changes(spark).write.parquet(f"{tmp_path}/in")
    q = refresh_stream(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), f"{tmp_path}/layer", "id", "m", "u", "w", f"{tmp_path}/cp")
    q.awaitTermination()
    assert stream_identity(spark, f"{tmp_path}/cp") == str(q.id)
