"""The registered functions themselves, against their SQL where there is one, on whole small tables."""

import duckdb
import pytest

from wayside.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as from '{FOLDER}/{t}.parquet'")
    out = con.execute(ORACLE[name])
    names = sorted(c[0] for c in out.description)
    wanted = [dict(zip([c[0] for c in out.description], r, strict=True)) for r in out.fetchall()]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == names
    plain = lambda rows: sorted(repr([r[n] for n in names]) for r in rows)
    assert plain(r.asDict() for r in got.collect()) == plain(wanted)


COLUMNS = {
    "op2_sentencepiece": ["doc_id", "n_tokens", "ids_hash", "text_sha256", "round_trip"],
    "op4_quality": ["doc_id", "held_out", "score", "predicted"],
    "op6_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op7_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_lm_score": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    out = QUERIES[name](spark, FOLDER)
    assert out.columns == COLUMNS[name]
    ids = sorted(r.doc_id for r in out.select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())
