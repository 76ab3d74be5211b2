"""Decoding pipe subtypes, and profiles of the decoded tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayside.functions.material import material_color, row_family, substring_family
from wayside.functions.text import audit_text, norm_code, short_code
from wayside.sources.pages import stored

DECODED = ["ASSETGROUP_DECODED", "ASSETTYPE_DECODED", "ASSETTYPE_DOMAIN", "PipeMaterialFamily"]
REQUIRED = ["ASSETGROUP", "ASSETTYPE", *DECODED, "PipeMaterialRaw", "GradeMaterial", "material"]
DOMAIN_SCHEMA = "typeIdField string, types array<struct<id:string,name:string,domains:map<string,struct<name:string,codedValues:array<struct<code:string,name:string>>>>>>"


def decoder(metadata: DataFrame) -> DataFrame:
    """group_code, type_code and decoded columns, from layer metadata read with
    DOMAIN_SCHEMA; subtypes without an ASSETTYPE domain are left out."""
    t = metadata.select(F.explode("types").alias("t")).select("t.id", "t.name", F.filter(F.map_entries("t.domains"), lambda e: F.upper(e["key"]) == "ASSETTYPE").alias("d"))
    t = t.filter("size(d) > 0").select("id", "name", F.get("d", F.lit(0))["value"].alias("d"))
    rows = t.select(norm_code("id").alias("group_code"), F.col("name").alias("ASSETGROUP_DECODED"), F.col("d.name").alias("ASSETTYPE_DOMAIN"), F.explode("d.codedValues").alias("v"))
    rows = rows.select("group_code", norm_code("v.code").alias("type_code"), "ASSETGROUP_DECODED", F.col("v.name").alias("ASSETTYPE_DECODED"), "ASSETTYPE_DOMAIN")
    return rows.withColumn("PipeMaterialFamily", row_family("ASSETTYPE_DECODED"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOMAIN_SCHEMA).option("multiLine", True).json(path)


def enrich_pipes(pipes: DataFrame, decoder_rows: DataFrame) -> DataFrame:
    """Pipes with decoded columns, always derived anew from the codes: the raw code,
    the decoded material, and the former material kept once as the grade. The decoder, a row for
    each coded value of the metadata, is sent to the pipes: by their few codes they would gather in few tasks."""
    grade = F.col("GradeMaterial") if "GradeMaterial" in pipes.columns else F.col("material") if "material" in pipes.columns else F.lit(None).cast("string")
    rest = pipes.withColumn("__grade", grade.cast("string")).drop(*DECODED, "PipeMaterialRaw", "GradeMaterial", "material")
    keyed = rest.withColumn("group_code", norm_code("ASSETGROUP")).withColumn("type_code", norm_code("ASSETTYPE"))
    out = keyed.join(F.broadcast(decoder_rows), ["group_code", "type_code"], "left").drop("group_code", "type_code")
    return out.withColumnRenamed("__grade", "GradeMaterial").withColumn("PipeMaterialRaw", F.col("ASSETTYPE")).withColumn("material", F.col("ASSETTYPE_DECODED"))


def attach_attributes(pipes: DataFrame, attributes: DataFrame, key: str = "OBJECTID", order: tuple[str, ...] = ()) -> DataFrame:
    """Service attributes by id; of repeated ids the first row by these columns, then by all others."""
    rest = [c for c in attributes.columns if c != key and c not in order]
    first = attributes.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order, *rest))).filter("__n = 1").drop("__n")
    return pipes.join(first, key, "left")


def already_enriched(df: DataFrame) -> bool:
    return all(c in df.columns for c in ("ASSETGROUP", "ASSETTYPE", "ASSETTYPE_DECODED", "PipeMaterialFamily")) and bool(df.filter("ASSETTYPE is not null").limit(1).count())


def decode_counts(enriched: DataFrame) -> DataFrame:
    by = ["ASSETGROUP", "ASSETTYPE", "ASSETGROUP_DECODED", "ASSETTYPE_DECODED", "PipeMaterialFamily"]
    return enriched.groupBy(*by).agg(F.count("*").alias("n"))


def fill_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, filled, of_rows, sample (the first three distinct values in order)."""
    wide = df.agg(
        F.count("*").alias("of_rows"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
    )
    counts = wide.select("of_rows", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("filled")) for i, c in enumerate(columns)])).alias("s")).select("s.column_name", "s.filled", "of_rows")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("s")).select("s.*")
    three = long.filter("v is not null").groupBy("column_name", "v").agg(F.lit(1).alias("one"))
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy("v"))
    sample = three.withColumn("k", rank).filter("k <= 3").groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_list("v")), ", ").alias("sample"))
    return counts.join(sample, "column_name", "left").select("column_name", "filled", "of_rows", F.coalesce("sample", F.lit("-")).alias("sample"))


def preflight(df: DataFrame, must_fill: list[str]) -> str:
    """NOT ENRICHED, ENRICHED BUT EMPTY or PASS."""
    if any(c not in df.columns for c in REQUIRED):
        return "NOT ENRICHED"
    filled = df.agg(*[F.count(c).alias(c) for c in must_fill]).first()
    return "ENRICHED BUT EMPTY" if any(filled[c] == 0 for c in must_fill) else "PASS"


def collapsed(df: DataFrame, family: str = "PipeMaterialFamily") -> DataFrame:
    """families, rows, and whether more than one row shares a single family."""
    return df.agg(F.count_distinct(family).alias("families"), F.count("*").alias("n")).withColumn("collapsed", (F.col("families") == 1) & (F.col("n") > 1))


def family_impact(df: DataFrame, column: str) -> DataFrame:
    """Distinct values whose family differs from the former substring rule, with their rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.withColumn("family_before", substring_family("value")).withColumn("family_after", row_family("value")).filter("family_before <> family_after")


def affected_rows(df: DataFrame, column: str) -> DataFrame:
    return df.join(family_impact(df, column).select(F.col("value").alias(column)), column, "left_semi")


def impact_share(df: DataFrame, column: str) -> DataFrame:
    """One row: all rows, the values and rows whose family differs, and their percent of all rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).withColumn("changed", F.col("value").isNotNull() & (substring_family("value") != row_family("value")))
    zero = F.lit(0)
    out = counts.agg(F.coalesce(F.sum("n"), zero).alias("n"), F.count_if("changed").alias("changed_values"), F.coalesce(F.sum(F.when(F.col("changed"), F.col("n"))), zero).alias("changed_rows"))
    return out.withColumn("percent", F.round(100 * F.col("changed_rows") / F.greatest("n", F.lit(1)), 2))


def wanted_rows(fetched: DataFrame, wanted: DataFrame, key: str, wanted_key: str | None = None) -> DataFrame:
    """Fetched rows whose id is wanted; ids that are no integers are skipped, null ids match nothing."""
    text = F.trim(F.col(key).cast("string"))
    rows = fetched.withColumn(key, F.when(text.rlike(r"^[-+]?\d+$"), text.try_cast("long")))
    return rows.join(wanted.select(F.col(wanted_key or key).cast("long").alias(key)), key, "left_semi")


def first_rows(df: DataFrame, by: list[str], n: int) -> DataFrame:
    """The report's sample: the first n rows in the order of the given columns."""
    return df.orderBy(*by).limit(n)


def display_pipes(enriched: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The viewer's pipe columns: the raw code, its decoded domain (never the grade), family, colour, diameter, and carried ones."""
    out = enriched.select("pipe_oid", *carry, F.col("ASSETTYPE").cast("string").alias("PipeMaterialRaw"), F.col("ASSETTYPE_DECODED").alias("PipeMaterialDomain"), row_family("ASSETTYPE_DECODED").alias("PipeMaterialFamily"), F.col("nominaldiameter").alias("PipeDiameter"))
    return out.withColumn("PipeMaterialColor", material_color("PipeMaterialFamily"))


def audit_output(relocated: DataFrame, pipes: DataFrame) -> DataFrame:
    """Relocated leaks against the pipe tables (one table with a layer column)."""
    p = pipes.select(F.lower("layer").alias("__layer"), F.col("pipe_oid").alias("MatchedPipeOID"), F.col("material").alias("PipeCache_material"), F.col("ASSETTYPE_DECODED").alias("PipeCache_ASSETTYPE_DECODED"))
    known = p.select("__layer").distinct().withColumn("__known", F.lit(True))
    j = relocated.withColumn("__layer", F.lower("LinkedLayer")).join(p, ["__layer", "MatchedPipeOID"], "left").join(known, "__layer", "left")
    m = audit_text("MatchMaterial")
    return j.select(
        "OrigLeakOID", "LeakKey", "LinkedLayer", "MatchedPipeOID", "MatchMaterial", "PipeCache_material", "PipeCache_ASSETTYPE_DECODED",
        (m == audit_text("PipeCache_ASSETTYPE_DECODED")).alias("equals_decoded"), (m == audit_text("PipeCache_material")).alias("equals_material"), short_code("MatchMaterial").alias("looks_like_old_code"),
        F.when(F.col("__known").isNull(), "No pipe table for LinkedLayer").alias("AuditStatus"),
    )


def audit_totals(audit: DataFrame) -> DataFrame:
    return audit.groupBy("LinkedLayer").agg(F.count("*").alias("n"), F.count_if("equals_decoded").alias("equals_decoded"), F.count_if("equals_material").alias("equals_material"), F.count_if("looks_like_old_code").alias("looks_like_old_code"))


def value_counts(df: DataFrame, column: str, top: int = 20) -> DataFrame:
    """The most frequent values, null among them; ties by value."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("value")).limit(top)


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, sample deviation, extremes and interpolated percentiles of a column's values; null,
    NaN and infinite ones do not count. The column is stored once, as it is read several times."""
    c = F.col(column).cast("double")
    values = stored(df.select(c.alias("v")).filter(F.abs("v") < float("inf")))
    one = values.agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("low"), F.max("v").alias("high"))
    row = one.first()
    found = percentiles(values, "v", list(PERCENTILES.values()), row["n"], row["low"], row["high"])
    return one.select("*", *[F.lit(x).cast("double").alias(name) for name, x in zip(PERCENTILES, found, strict=True)])


PERCENTILES = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
RANGES = 1024


def percentiles(df: DataFrame, column: str, shares: list[float], n: int, low: float, high: float) -> list[float | None]:
    """Exact percentiles, interpolated between neighbours, by rank selection over histograms: each
    pass counts the values in RANGES parts of the ranges that hold a wanted rank, with the least and
    the largest value of each part, and goes on in the part that holds it until that is one value.
    A pass is a hash aggregate that is combined before it is shuffled; no task gathers values, and
    the driver sees up to 2 x RANGES counts for each share."""
    if not n:
        return [None] * len(shares)
    places = [p * (n - 1) for p in shares]
    ranks = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    # rank -> (values below its range, least, largest)
    at = dict.fromkeys(ranks, (0, low, high))
    v = F.col(column)
    while open_ := sorted({x for x in at.values() if x[1] < x[2]}):
        parts = []
        for i, (_, a, b) in enumerate(open_):
            step = b / RANGES - a / RANGES or math.ulp(a)
            part = F.least(F.floor((v - F.lit(a)) / F.lit(step)).cast("int"), F.lit(RANGES - 1))
            parts.append(F.when(v.between(a, b), F.struct(F.lit(i).alias("i"), part.alias("part"))))
        counted = df.select(v.alias("v"), F.explode(F.array_compact(F.array(*parts))).alias("p")).groupBy("p.i", "p.part").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
        found: dict[int, list] = {}
        for r in sorted(counted.collect(), key=lambda r: (r["i"], r["part"])):
            found.setdefault(r["i"], []).append(r)
        for rank, (below, a, b) in at.items():
            if a < b:
                for r in found[open_.index((below, a, b))]:
                    if rank < below + r["n"]:
                        at[rank] = (below, r["a"], r["b"])
                        break
                    below += r["n"]
    out = []
    for p in places:
        lo, hi = math.floor(p), math.ceil(p)
        out.append(at[lo][1] if lo == hi else (hi - p) * at[lo][1] + (p - lo) * at[hi][1])
    return out
