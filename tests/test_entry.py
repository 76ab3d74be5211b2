"""Registered relocation queries against their SQL, on a few small derived tables."""

import datetime as dt
import importlib
import sys

import duckdb
import pytest

from wayside.plans.oracle import ORACLE
from wayside.plans.queries import QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    day = dt.datetime(1995, 1, 1)
    spark.createDataFrame([(k, k % 97, day + dt.timedelta(days=k % 900)) for k in range(1, 400)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(1 + k % 399, 1 + k % 53, 1 + k % 41, 1 + k // 399) for k in range(4000)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(k, day + dt.timedelta(seconds=977 * k), k % 7, "error" if k % 5 == 0 else "view") for k in range(900)], "event_id long, ts timestamp_ntz, user_id long, event_type string").write.parquet(f"{d}/events.parquet")
    spark.createDataFrame([(k, f"Customer#{k}", k % 25, "AUTO") for k in range(300)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events", "customer"):
        con.execute(f"create view {t} as select * from read_parquet('{d}/{t}.parquet/*.parquet')")
    return d, con


def plain(rows, columns, order):
    at = [columns.index(c) for c in order]
    fix = lambda v: int(v) if isinstance(v, float) and v == int(v) else v
    return sorted(repr(tuple(fix(r[i]) for i in at)) for r in rows)


@pytest.mark.parametrize("name", ["clean_keys", "family_match", "supplement_leaks", "enrich_pipes", "preflight_profile", "relocated_leaks", "relocation_audit", "run_counters", "viewport_lines", "reproject_points", "parse_numbers", "upsert_layer", "delta_rows", "refresh_watermark", "refresh_decision", "stream_latest", "date_variants", "date_export_text", "csv_file_order", "clustered_view", "paged_source", "two_systems", "watermark_literals", "date_export", "feature_pages", "display_leaks", "layer_sample", "simplify_lines", "geojson_features", "paged_layer", "job_relocated_leaks", "job_offset_lines", "job_audit", "enrich_job", "report_counts", "report_rows", "viewport_answer", "context_export", "viewer_export", "export_job", "export_count", "refresh_job"])
def test_against_sql(spark, tables, name):
    d, con = tables
    df = QUERIES[name](spark, d)
    rows = df.collect()
    out = con.execute(ORACLE[name])
    names = [c[0] for c in out.description]
    assert sorted(names) == sorted(df.columns)
    assert plain(rows, df.columns, sorted(names)) == plain(out.fetchall(), names, sorted(names))


def test_imports_without_the_training_data_operators(monkeypatch):
    for m in [m for m in sys.modules if m.startswith(("wayside.llm", "corpus_pipeline", "__spark_entry__"))]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLE)


def test_watermark_of_all_events(spark, tables):
    """The latest event has an odd id."""
    d, con = tables
    rows = QUERIES["refresh_watermark_all"](spark, d).collect()
    assert [tuple(r) for r in rows] == con.execute(ORACLE["refresh_watermark_all"]).fetchall()
    assert rows[0].ms == con.execute("select epoch_us(max(ts)) // 1000 from events").fetchone()[0] == max(r.ms for r in QUERIES["refresh_watermark"](spark, d).collect())


def test_refresh_of_a_copy_that_grows(spark, tables):
    d, con = tables
    got = sorted(tuple(r) for r in QUERIES["refresh_merged"](spark, d).collect())
    assert got == sorted(con.execute(ORACLE["refresh_merged"]).fetchall())
    assert len(got) == 900 and sum(r[1] == "old" for r in got) == 810
