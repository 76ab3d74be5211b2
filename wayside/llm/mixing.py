"""Mixing sources to target weights by a low-discrepancy schedule.

The documents of a source, in a seeded shuffle, form one line of words, cut into
blocks of equal numbers of words. Slots 0, 1, 2 ... get points of a golden-ratio
sequence, which the cumulative source targets map to sources; the r-th slot of a
source takes the source's block r (the line starts again when it is used up, at
most three times; slots beyond that stay empty). So the schedule decides how much
of a source is taken: its slots are as many as its points, which miss its target by
a few blocks at most, in every prefix of the mix as in the whole. Blocks have block_words
words, fewer where the mix would have under least_slots slots.

Scale: the text is read once for its word counts. Sources are numbered and all running
sums are taken in two levels (range of sources, source and shuffle-key prefix, source
and slot chunk), so neither many sources nor one with any part of the rows meet in a
task. Only three scalars reach the driver in each round of resharing.

Defined results: null text has size 0; null source is a source of its own, last
in order; ids may be null or repeat, each row is a document; without words all
targets are 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayside.llm.common import WORD_PATTERN, materialise

BLOCK_WORDS = 128
LEAST_SLOTS = 4096
SEED = "mix-1"
MAX_REPEAT = 3
CHUNK_BITS = 16
CELL_BITS = 10
#: Odd integer nearest 2^32 divided by the golden ratio.
GOLDEN_32 = 2654435769


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(sid, source, source_size, target): sources by code point, null last,
    weigh by turns; shares above max_repeat times the size are reshared."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    code = F.col("source").cast("binary").asc_nulls_last()
    sources = materialise(sources.repartitionByRange(code).withColumn("range", F.spark_partition_id()))
    held = sources.groupBy("range").agg(F.count("*").alias("n"))
    before = held.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("base"))  # one row a range
    inside = F.row_number().over(Window.partitionBy("range").orderBy(code)) - 1
    sources = sources.withColumn("inside", inside).join(before, "range").select("source", "source_size", (F.col("base") + F.col("inside")).cast("long").alias("sid"))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    sources = materialise(sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * max_repeat))
    capped, rate = -1, 0.0
    above = F.lit(False)
    while True:
        x = sources.agg(
            F.coalesce(F.sum(F.when(above, 1)), F.lit(0)).alias("n"),
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("free"),
        ).first()
        if x["n"] == capped or not x["free"]:
            break
        capped, rate = x["n"], (x["total"] - x["held"]) / x["free"]
        above = above | (F.col("most") < F.col("weight") * F.lit(rate))
    target = F.when(above, F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(rate))
    return sources.select("sid", "source", "source_size", target.alias("target"))


def _slots(targets: DataFrame, total: int, block_words: int) -> DataFrame:
    """(sid, r, slot): golden-ratio points through the cumulative targets; r is the slot's rank in its source."""
    spark = targets.sparkSession
    goal = F.round("target").cast("long")
    share = targets.select("sid", goal.alias("goal"), F.shiftright("sid", CHUNK_BITS).alias("chunk"))
    sums = share.groupBy("chunk").agg(F.sum("goal").alias("n"))
    before = sums.select("chunk", (F.sum("n").over(Window.orderBy("chunk")) - F.col("n")).alias("base"))  # one row for 2^16 sources
    inside = F.sum("goal").over(Window.partitionBy("chunk").orderBy("sid"))
    share = share.withColumn("inside", inside).join(before, "chunk").select("sid", "goal", (F.col("base") + F.col("inside")).alias("upto"))
    count = -(-total // block_words)
    grid = lambda c: F.floor(c.cast("double") / max(total, 1) * F.lit(1 << 32)).cast("long")
    share = share.select("sid", grid(F.col("upto") - F.col("goal")).alias("lo"), grid(F.col("upto")).alias("hi")).filter("hi > lo")
    shift = 32 - CELL_BITS
    cells = share.withColumn("cell", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))))
    slots = spark.range(count).withColumn("point", (F.col("id") % (1 << 31) * F.lit(GOLDEN_32)) % (1 << 32)).withColumn("cell", F.shiftright("point", shift))
    slots = slots.join(cells, "cell").filter("point >= lo and point < hi").select("sid", F.col("id").alias("slot"), F.shiftright("id", CHUNK_BITS).alias("chunk"))
    slots = materialise(slots)
    sums = slots.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    before = sums.withColumn("base", F.sum("n").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("n")).drop("n")
    inside = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    return materialise(slots.withColumn("inside", inside).join(before, ["sid", "chunk"]).select("sid", (F.col("base") + F.col("inside")).alias("r"), "slot"))


def mix_stream(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_words: int = BLOCK_WORDS, seed: str = SEED, weights: tuple[int, ...] = (1, 2, 3), least_slots: int = LEAST_SLOTS) -> tuple[DataFrame, DataFrame]:
    """The documents with their source's size and target, and the mix itself:
    (slot, sid, r, uid, epoch, first_word, words) says which words of which
    document (uid) a slot takes."""
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|" + seed)))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    sized = materialise(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key")))
    targets = materialise(source_targets(sized, weights))
    sized = sized.join(targets.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    sized = materialise(sized.withColumn("part", F.substring("key", 1, 3)))
    sums = sized.groupBy("sid", "part").agg(F.sum("size").alias("n"))
    before = sums.withColumn("base", F.sum("n").over(Window.partitionBy("sid").orderBy("part")) - F.col("n")).drop("n")
    inside = F.sum("size").over(Window.partitionBy("sid", "part").orderBy("key", "doc_id", "size", "uid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    line = sized.filter("size > 0").withColumn("inside", inside).join(before, ["sid", "part"]).withColumn("start", F.col("base") + F.col("inside"))
    line = materialise(line.select("sid", "uid", "size", "source_size", "target", "start"))
    total = targets.agg(F.sum(F.round("target").cast("long"))).first()[0] or 0
    w = max(1, min(block_words, total // least_slots))
    slots = _slots(targets, total, w)
    held = slots.groupBy("sid").agg((F.count("*") * w).alias("most"))
    turns = line.join(held, "sid").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(MAX_REPEAT - 1))))
    turns = turns.withColumn("a", F.col("epoch") * F.col("source_size") + F.col("start"))
    turns = turns.withColumn("b", F.least(F.col("a") + F.col("size"), F.col("most"))).filter("a < b")
    pieces = turns.withColumn("r", F.explode(F.sequence(F.expr(f"a div {w}"), F.expr(f"(b - 1) div {w}"))))
    pieces = pieces.select("sid", "r", "uid", "epoch", (F.greatest("a", F.col("r") * w) - F.col("a")).alias("first_word"), (F.least(F.col("b"), (F.col("r") + 1) * w) - F.greatest("a", F.col("r") * w)).alias("words"))
    pieces = materialise(pieces)
    stream = slots.join(pieces, ["sid", "r"]).select("slot", "sid", "r", "uid", "epoch", "first_word", "words")
    return sized.select("uid", "doc_id", "size", "source_size", "target"), stream


def mix_taken(docs: DataFrame, **options) -> DataFrame:
    """One row per document: uid, doc_id, size, source_size, target, taken (words the mix
    takes, repeats counted) and first_slot (where the mix first takes of it, or null)."""
    sized, stream = mix_stream(docs, **options)
    taken = stream.groupBy("uid").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    return sized.join(taken, "uid", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
