"""A corpus pipeline over documents: rank quality, drop copies, drop near copies, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept; all but the last return the columns of documents. Rows are told apart by their
place in the stored input, so null or repeated ids keep their rows apart.

Defined results: other columns are ignored; an empty table stays empty in every stage;
what a stage does with null, empty and equal texts is said at the stage; texts of any
length are taken whole. The n-gram join limits the session's Arrow batches to 8 MB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayside.llm.common import materialise, read_table
from wayside.llm.exact_dedup import exact_dedup
from wayside.llm.mixing import mix_taken
from wayside.llm.ngram_join import ngram_join
from wayside.llm.quality import score_quality, train_quality
from wayside.llm.sentencepiece_scan import encode

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("uid"), *COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that rank under the threshold go; one that ranks at it stays. Null and empty texts are
    ranked too (by features of zero). Without labels of both kinds all stay."""
    model = train_quality(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs.select(*COLUMNS), model).filter("quality_score >= 0.5").select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays, with the largest id (a null id is the smallest; of rows with
    that id one). Null is the empty text."""
    stays = exact_dedup(docs).filter("stays").select("uid")
    return _numbered(docs).join(stays, "uid", "left_semi").select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays, with the smallest id (of rows with that id the
    first; a null id only if all are null). Texts without words, null among them, link with nothing and stay."""
    stays = ngram_join(docs).filter("stays").select("uid")
    return _numbered(docs).join(stays, "uid", "left_semi").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is repeated as often as the mix begins it: up to 3 times, or not at all. Texts without
    words have nothing to give and go. Null is a source of its own, the last."""
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    taken = mix_taken(docs).filter("taken > 0").select("uid", times.alias("times"))
    return _numbered(docs).join(taken, "uid").select(*COLUMNS, F.explode(F.sequence(F.lit(1), "times")).alias("turn")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, and whether they decode to its text. Null and empty texts have no ids and decode to the empty text."""
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    coded = encode(docs.withColumn("sha256", digest), keep=("doc_id", "lang", "source", "sha256"), decoded=True)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), F.col("ids").alias("token_ids"), (F.col("decoded_sha256") == F.col("sha256")).alias("round_trip"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", tokens),
]

#: SQL can't express the learned ranking or the encoding; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
