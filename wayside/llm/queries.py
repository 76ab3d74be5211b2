"""The operators' registered queries over their whole tables, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayside.llm.common import crc_bucket, read_table
from wayside.llm.embed_dedup import embedding_dedup
from wayside.llm.exact_dedup import exact_dedup
from wayside.llm.langid import predict_language, train_langid
from wayside.llm.lm_score import score, train
from wayside.llm.mixing import mix_taken
from wayside.llm.ngram_join import ngram_join
from wayside.llm.quality import score_quality, train_quality
from wayside.llm.sentencepiece_scan import encode
from wayside.llm.suffix_dedup import suffix_dedup
from wayside.llm.token_count import count_tokens
from wayside.llm.va_cluster import cluster_vectors
from wayside.llm.warc import read_warc, with_revisits, write_warc
from wayside.llm.whitening import whiten


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, a hash of the ids, the decoded text's SHA-256 and whether it is the original's."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha256"))
    coded = encode(docs, keep=("doc_id", "sha256"), decoded=True)
    digest = F.col("decoded_sha256")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), digest.alias("text_sha256"), (digest == F.col("sha256")).alias("round_trip"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents")).drop("uid", "stays")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train_quality(docs, read_table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_taken(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return predict_language(docs, train_langid(docs)).select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_warc(with_revisits(read_table(spark, sf_dir, "pages")))
    return read_warc(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read_table(spark, sf_dir, "embeddings"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    trie = train(docs, min_count=1, order=3)
    return score(docs, trie).select("doc_id", (crc_bucket("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(trie.total).cast("long").alias("train_tokens"), "base_score", "score")


def op11_va_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read_table(spark, sf_dir, "embeddings")).drop("fetched")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_language": op6_language,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_warc": op8_warc,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_lm_score": op10_lm_score,
    "op11_va_cluster": op11_va_cluster,
    "op12_whitening": op12_whitening,
    "op13_token_counts": op13_token_counts,
}

_ROUND = """d{this} AS MATERIALIZED (SELECT u, j, sum((c - m) * (c - m)) AS distance FROM p JOIN c{this} USING (d) GROUP BY u, j),
a{this} AS MATERIALIZED (SELECT u, j FROM d{this} QUALIFY row_number() OVER (PARTITION BY u ORDER BY distance, j) = 1),
s{this} AS (SELECT j, d, CAST(sum(c) AS BIGINT) AS s, count(*) AS n FROM a{this} JOIN p USING (u) GROUP BY j, d),
c{following} AS MATERIALIZED (SELECT j, d, coalesce((s - ((s % n) + n) % n) // n, m) AS m FROM c{this} LEFT JOIN s{this} USING (j, d)),
"""

ORACLE = {
    "op3_exact_dedup": """
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, false) AS kept, text_sha256
FROM (SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
             sha256(coalesce(text, '')) AS text_sha256
      FROM documents WINDOW w AS (PARTITION BY coalesce(text, '')))""",
    "op5_mixing": """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|mix-1') AS k
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
wts AS (SELECT *, 1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS most FROM src),
steps AS (
  SELECT *, row_number() OVER o AS j, CAST(sum(most) OVER o AS BIGINT) AS held, CAST(sum(weight) OVER () - sum(weight) OVER o AS BIGINT) AS free,
         CAST(sum(source_size) OVER () AS BIGINT) AS total, most::DOUBLE / weight AS ratio
  FROM wts WINDOW o AS (ORDER BY most::DOUBLE / weight, source ROWS UNBOUNDED PRECEDING)),
cand AS (
  SELECT 0 AS j, max(total)::DOUBLE / (SELECT sum(weight)::BIGINT FROM wts) AS rate FROM steps
  UNION ALL SELECT j, (total - held)::DOUBLE / free FROM steps WHERE free > 0),
pick AS (
  SELECT c.j, c.rate FROM cand c
  WHERE NOT EXISTS (SELECT 1 FROM steps s WHERE s.j > c.j AND s.most < s.weight * c.rate)
  ORDER BY c.j LIMIT 1),
tgt AS (
  SELECT s.source, s.source_size, CASE WHEN s.j <= p.j THEN s.most::DOUBLE ELSE s.weight * p.rate END AS target FROM steps s, pick p),
share AS (
  SELECT source, CAST(round(target) AS BIGINT) AS goal, CAST(sum(round(target)) OVER (ORDER BY encode(source) NULLS LAST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto,
         CAST(sum(round(target)) OVER () AS BIGINT) AS total FROM tgt),
grid AS (
  SELECT source, CAST(floor((upto - goal)::DOUBLE / total::DOUBLE * 4294967296::DOUBLE) AS BIGINT) AS lo,
         CAST(floor(upto::DOUBLE / total::DOUBLE * 4294967296::DOUBLE) AS BIGINT) AS hi FROM share WHERE total > 0),
block AS (SELECT greatest(1, least(128, max(total) // 4096)) AS w, max(total) AS total FROM share),
points AS (
  SELECT i, ((i % 2147483648) * 2654435769) % 4294967296 AS point
  FROM (SELECT unnest(generate_series(0, CAST((total + w - 1) // w AS BIGINT) - 1)) AS i FROM block)),
slots AS (
  SELECT source, i AS slot, row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS r FROM points JOIN grid ON point >= lo AND point < hi),
held AS (SELECT source, max(w) * count(*) AS most FROM slots, block GROUP BY source),
line AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, coalesce(h.most, 0) AS most,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start
  FROM sized d JOIN tgt t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN held h ON d.source IS NOT DISTINCT FROM h.source)
SELECT l.doc_id, l.size, l.source_size, l.target,
  CAST(greatest(0, least(l.size, l.most - start)) + greatest(0, least(l.size, l.most - start - l.source_size))
     + greatest(0, least(l.size, l.most - start - 2 * l.source_size)) AS BIGINT) AS taken,
  CASE WHEN l.size > 0 THEN s.slot END AS first_slot
FROM line l LEFT JOIN slots s ON l.source IS NOT DISTINCT FROM s.source AND s.r = l.start // (SELECT w FROM block)""",
    "op11_va_cluster": f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS u, vec_id, [CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT) for c in embedding] AS x
  FROM embeddings WHERE len(embedding) = 64 AND len([c for c in embedding if isfinite(c)]) = 64),
p AS MATERIALIZED (SELECT u, unnest(x) AS c, generate_subscripts(x, 1) AS d FROM v),
c0 AS MATERIALIZED (
  SELECT j, d, c AS m FROM (SELECT u, row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS j FROM v QUALIFY j < 16) JOIN p USING (u)),
{"".join(_ROUND.format(this=r, following=r + 1) for r in range(3))}
d3 AS MATERIALIZED (SELECT u, j, CAST(sum((c - m) * (c - m)) AS BIGINT) AS distance FROM p JOIN c3 USING (d) GROUP BY u, j),
a3 AS MATERIALIZED (SELECT * FROM d3 QUALIFY row_number() OVER (PARTITION BY u ORDER BY distance, j) = 1),
named AS (SELECT j, sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c3 GROUP BY j)
SELECT vec_id, CAST(j AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a3 JOIN v USING (u) JOIN named USING (j)""",
    "op1_ngram_join": """
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t-\\r]+'), []) AS words FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS i FROM w WHERE len(words) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, min(r.b)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach r ON r.a = w.doc_id GROUP BY w.doc_id, n.n""",
    "op9_embedding_dedup": """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS size
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE len(embedding) > 0 AND len([c for c in embedding if isfinite(c)]) = len(embedding))
  WHERE list_dot_product(x, x) > 0),
link AS MATERIALIZED (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
  WHERE list_dot_product(p.x, q.x) / (p.size * q.size) >= 0.95),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, low.b) AS component_id, vec_id = least(vec_id, low.b) AS kept
FROM embeddings LEFT JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id""",
}
