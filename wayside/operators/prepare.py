"""Leaks, supplemental attributes and pipes made ready for matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayside.functions.material import MATERIAL_RULES, material_label, route_layers, with_rules
from wayside.functions.text import clean, normalize_key, number_or_null, parse_number


def last_row(df: DataFrame, key: str, order: list) -> DataFrame:
    """The last row of each key in a given order."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def first_row(df: DataFrame, key: str, order: list) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*[F.asc(c) for c in order])
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def supplemental(raw: DataFrame) -> DataFrame:
    """leak_key, diameter, material, pressure, facility; of rows with one key the last counts."""
    texts = ["Diameter", "LeakMaterialType", "FacilityType", "Pressure"]
    # only the texts are shuffled; the key, told by a generator, is made once a row and not again in the filter
    keyed = raw.select(F.explode(F.array(normalize_key("LeakNumber"))).alias("leak_key"), "ordinal", F.struct(*texts).alias("__texts"))
    last = last_row(keyed.filter("leak_key <> ''"), "leak_key", ["ordinal", "__texts"]).select("leak_key", "__texts.*")
    return with_rules(last, "LeakMaterialType", MATERIAL_RULES, of=raw).select(
        "leak_key",
        parse_number("Diameter").alias("leak_diameter"),
        F.col("material").alias("leak_material"),
        "label",
        "family",
        clean("Pressure").alias("leak_pressure"),
        clean("FacilityType").alias("facility"),
    )


def gated_leaks(leaks: DataFrame, supp: DataFrame) -> DataFrame:
    """All leaks with their attributes and a gate: ready, missing_supplemental or missing_match_attributes."""
    gid = [c for c in ("leak_gid",) if c in leaks.columns]
    keyed = leaks.select("leak_oid", normalize_key("leak_key_raw").alias("leak_key"), "x", "y", *gid)
    joined = keyed.join(supp.withColumn("has_supp", F.lit(True)), "leak_key", "left")
    gate = F.when(F.col("has_supp").isNull(), "missing_supplemental").when(F.col("leak_diameter").isNull() | (F.col("leak_material") == ""), "missing_match_attributes").otherwise("ready")
    return joined.select("leak_oid", "leak_key", "x", "y", *gid, "leak_diameter", "leak_material", "leak_pressure", "facility", "label", "family", gate.alias("gate"))


def leak_tasks(gated: DataFrame) -> DataFrame:
    ready = gated.filter("gate = 'ready'").drop("gate")
    return ready.withColumn("allowed_layers", route_layers("facility"))


def prepared_pipes(pipes: DataFrame, material: str = "material") -> DataFrame:
    """Canonical pipe columns; missing material ('') and diameter (null) are kept."""
    return with_rules(pipes, material, {"__label": material_label}).select(
        "layer", "pipe_oid", F.col("__label").alias("material"), number_or_null("nominaldiameter").alias("diameter"), clean("operatingpressure").alias("pressure"),
        *[c for c in ("x1", "y1", "dx", "dy", "paths") if c in pipes.columns],
    )


def pipe_gaps(prepared: DataFrame) -> DataFrame:
    return prepared.groupBy("layer").agg(F.count("*").alias("pipes"), F.count_if(F.col("material") == "").alias("missing_material"), F.count_if(F.col("diameter").isNull()).alias("missing_diameter"))
