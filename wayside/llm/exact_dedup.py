"""Exact dedup by deterministic block naming.

Each text is cut into fixed-size byte blocks. The distinct blocks are sorted and
numbered, so equal blocks share one integer name and different blocks never do.
Adjacent names are then paired, and the distinct pairs are numbered again, level
by level, until one name is left for each text. (text length, last name) is the
text's collision-free identity: it is built from comparisons of contents, the
64-bit hash only routes blocks and is checked for collisions.

Scale: the text moves once (distinct blocks, pre-aggregated in the map tasks);
afterwards only integers move, and each level has half the rows of the last.
A block or text shared by any part of the rows is one row after the partial
aggregate, and joins back on a table with one row a key.

Defined results: a null text counts as empty, and empty texts are equal; rows
with the same text form a group whatever their other columns; of a group the
largest doc_id stays (nulls lose; a group of null ids keeps none); rows that
repeat both text and doc_id are all marked kept, as they are the same document;
an empty table gives an empty result; other columns are ignored. The input has to
be a stored table (it is read twice, and rows are told apart by their place in it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.llm.common import materialise

BLOCK_BYTES = 2048


def _blocks(data: Column, size: int) -> Column:
    """Array of the byte blocks of a binary column; an empty text is one empty block."""
    count = F.greatest(F.lit(1), F.ceil(F.length(data) / size)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _named(keys: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct keys in sorted order within their shuffle partition, with an integer name each."""
    return keys.groupBy(*columns).agg(F.count("*").alias("uses")).sortWithinPartitions(*columns).withColumn("name", F.monotonically_increasing_id())


def text_identity(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, route=F.xxhash64) -> DataFrame:
    """(doc_id, n_bytes, name, text_sha256) of each row; (n_bytes, name) agree
    exactly for equal texts. route only deals blocks out, any function will do."""
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = docs.select(F.col(id_col).alias("doc_id"), data.alias("data"))
    blocks = texts.select(F.explode(_blocks(F.col("data"), block_bytes)).alias("block")).select(route("block").alias("h"), "block")
    first = materialise(_named(blocks, ["h", "block"]).groupBy("h").agg(F.min("name").alias("name"), F.count("*").alias("contents")))
    rows = materialise(
        texts.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            F.length("data").alias("n_bytes"),
            F.sha2("data", 256).alias("text_sha256"),
            F.transform(_blocks(F.col("data"), block_bytes), lambda b: route(b)).alias("hashes"),
            F.col("data"),
        ).drop("data")
    )
    level = rows.select("uid", F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "h")).join(first, "h")
    if first.filter("contents > 1").limit(1).count():
        level = _split_collisions(texts, level, first, block_bytes, route)
    level = materialise(level.select("uid", "n", F.col("pos").cast("long").alias("pos"), "name"))
    done = level.filter("n = 1").select("uid", "name")
    left = level.agg(F.max("n")).first()[0] or 1
    while left > 1:
        pairs = (
            level.filter("n > 1")
            .groupBy("uid", F.shiftright("pos", 1).alias("pos"))
            .agg(F.max("n").alias("n"), F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        )
        pairs = materialise(pairs)
        names = materialise(_named(pairs.select("a", "b"), ["a", "b"]).drop("uses"))
        level = materialise(pairs.join(names, ["a", "b"]).select("uid", F.shiftright(F.col("n") + 1, 1).alias("n"), "pos", "name"))
        done = done.union(level.filter("n = 1").select("uid", "name"))
        left = (left + 1) // 2
    return rows.join(done, "uid").select("uid", "doc_id", "n_bytes", "name", "text_sha256")


def _split_collisions(texts: DataFrame, level: DataFrame, first: DataFrame, block_bytes: int, route) -> DataFrame:
    """Names by content for the blocks whose routing hash several contents share.
    Their texts are read again; the negative names keep clear of the others."""
    shared = first.filter("contents > 1").select("h")
    again = (
        texts.select(F.monotonically_increasing_id().alias("uid"), "data")
        .select("uid", F.posexplode(_blocks(F.col("data"), block_bytes)).alias("pos", "block"))
        .withColumn("h", route("block"))
        .join(shared, "h", "left_semi")
    )
    own = materialise(_named(again, ["h", "block"]).select("h", "block", (-2 - F.col("name")).alias("own")))
    renamed = again.join(own, ["h", "block"]).select("uid", "pos", "own")
    return level.join(renamed, ["uid", "pos"], "left").select("uid", "n", "pos", F.coalesce("own", "name").alias("name"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, route=F.xxhash64) -> DataFrame:
    """One row per document: uid, doc_id, keep_id, group_size, kept, text_sha256 and
    stays: kept, but for one row only where ids are null or repeat with their text."""
    named = materialise(text_identity(docs, id_col, text_col, block_bytes, route))
    groups = named.groupBy("n_bytes", "name").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.max(F.struct("doc_id", -F.col("uid"))).getField("col2").alias("stay"))
    return named.join(groups, ["n_bytes", "name"]).select(
        "uid", "doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256", (-F.col("uid") == F.col("stay")).alias("stays")
    )
