"""The relocation job and its three output tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.functions.material import search_ring
from wayside.functions.text import upper
from wayside.operators.nearest import nearest_within
from wayside.operators.prepare import last_row
from wayside.sources.pages import stored

MAX_RADIUS_FT = 3000.0


def match_leaks(tasks: DataFrame, segments: DataFrame, family_fallback: bool = True, require_pressure: bool = False, radius: float = MAX_RADIUS_FT, carry: tuple[str, ...] = ()) -> DataFrame:
    """Nearest agreeing pipe of every leak. segments: one row per segment with the
    prepared pipe columns; `carry` names more of them that the match brings along. Blank materials and null diameters never agree. Both sides
    bring their label and family; equal labels have equal families."""
    agree = "family" if family_fallback else "label"
    rank = F.when(F.col("layer") == "distribution", 0).otherwise(1)
    keys = ["layer", "layer_rank", "diameter", "agree", *(["press"] if require_pressure else [])]
    leaks = tasks.select("leak_oid", "x", "y", F.explode("allowed_layers").alias("layer"), F.col("leak_diameter").alias("diameter"), F.col(agree).alias("agree"), upper("leak_pressure").alias("press"))
    lines = segments.filter("material <> '' and diameter is not null").withColumn("agree", F.col(agree)).withColumn("press", upper("pressure"))
    leaks, lines = leaks.withColumn("layer_rank", rank), lines.withColumn("layer_rank", rank)
    if require_pressure:
        leaks, lines = leaks.filter("press <> ''"), lines.filter("press <> ''")
    else:
        leaks, lines = leaks.drop("press"), lines.drop("press")
    found = nearest_within(leaks, lines, "leak_oid", keys, radius, ["material", "pressure", *carry], ["layer_rank", "pipe_oid", "path_idx", "seg_idx"])
    return found.drop("agree", "press", "layer_rank")


def relocated_leaks(tasks: DataFrame, matches: DataFrame, **more: Column) -> DataFrame:
    """One row for every match; `more` names further columns of the tasks and matches."""
    return matches.join(tasks.select("leak_oid", "leak_key"), "leak_oid").select(
        F.col("leak_oid").alias("OrigLeakOID"), F.col("leak_key").alias("LeakKey"), F.col("layer").alias("LinkedLayer"), F.col("pipe_oid").alias("MatchedPipeOID"), F.col("distance").alias("DistanceFt"),
        search_ring("distance").alias("SearchRadiusFt"), F.col("material").alias("MatchMaterial"), F.col("diameter").alias("MatchDiameter"), F.col("pressure").alias("MatchPressure"), F.col("new_x").alias("x"), F.col("new_y").alias("y"),
        *[c.alias(name) for name, c in more.items()],
    )


def guide_lines(tasks: DataFrame, matches: DataFrame) -> DataFrame:
    """Lines from the original to the snapped point, as their two ends."""
    return matches.join(tasks.select("leak_oid", "leak_key", "x", "y"), "leak_oid").select(
        F.col("leak_oid").alias("LeakOID"), F.col("leak_key").alias("LeakKey"), F.col("layer").alias("LinkedLayer"), F.col("distance").alias("DistanceFt"), F.col("pipe_oid").alias("MatchedPipeOID"),
        F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("new_x").alias("x1"), F.col("new_y").alias("y1"),
    )


def relocation_audit(tasks: DataFrame, matches: DataFrame, **more: Column) -> DataFrame:
    """One row for every leak that passed the gate, matched or not; `more` as above."""
    m = matches.drop("path_idx", "seg_idx")
    j = tasks.join(m, "leak_oid", "left")
    hit = F.col("pipe_oid").isNotNull()
    return j.select(
        F.col("leak_oid").alias("LeakOID"), F.col("leak_key").alias("LeakKey"), F.col("leak_material").alias("LeakMaterial"), F.col("leak_diameter").alias("LeakDiameter"), F.col("leak_pressure").alias("LeakPressure"),
        F.col("facility").alias("FacilityType"), F.coalesce("layer", F.array_join("allowed_layers", ",")).alias("LinkedLayer"), F.col("pipe_oid").alias("MatchedPipeOID"), F.coalesce("material", F.lit("")).alias("PipeMaterial"),
        F.col("diameter").alias("PipeDiameter"), F.coalesce("pressure", F.lit("")).alias("PipePressure"), F.when(hit, search_ring("distance")).alias("SearchRadiusFt"), F.col("distance").alias("DistanceFt"),
        F.when(hit, "Matched").otherwise("NoMatch").alias("MatchStatus"), F.when(hit, "").otherwise(NO_MATCH).alias("NoMatchReason"), F.col("x").alias("OrigX"), F.col("y").alias("OrigY"), F.col("new_x").alias("NewX"), F.col("new_y").alias("NewY"),
        *[c.alias(name) for name, c in more.items()],
    )


NO_MATCH = "no agreeing pipe within the search radius"


def run_counters(gated: DataFrame, matches: DataFrame) -> DataFrame:
    """(name, n) of a run, in one row each."""
    hits = matches.select("leak_oid", F.lit(1).alias("hit"))
    one = gated.join(hits, "leak_oid", "left").agg(
        F.count("*").alias("leaks_read"), F.count_if(F.col("gate") == "missing_supplemental").alias("unmatched_missing_supplemental"), F.count_if(F.col("gate") == "missing_match_attributes").alias("unmatched_missing_match_attributes"),
        F.count_if((F.col("gate") == "ready") & F.col("hit").isNotNull()).alias("matched"), F.count_if((F.col("gate") == "ready") & F.col("hit").isNull()).alias("unmatched"),
    )
    return one.unpivot([], one.columns, "name", "n")


def write_outputs(tasks: DataFrame, matches: DataFrame, folder: str) -> None:
    """Three tables; each is replaced as a whole. The match is computed once."""
    matches = stored(matches)
    for name, table in (("relocated_leaks", relocated_leaks), ("relocated_leak_offset_lines", guide_lines), ("leak_relocation_audit", relocation_audit)):
        table(tasks, matches).write.mode("overwrite").parquet(f"{folder}/{name}")


def one_row_per_id(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of rows with one id the last counts."""
    return last_row(df, key, order)
