"""The relocation workload, derived from orders and lineitem by SQL that Spark and DuckDB both run.

Coordinates fall in a square of 184000 ft at every scale, so density grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayside.functions.material import LABELS, MATERIAL_RULES, with_rules
from wayside.operators.enrich import DOMAIN_SCHEMA, decoder, enrich_pipes
from wayside.operators.prepare import gated_leaks, leak_tasks, supplemental

LEAKS = """
select o_orderkey as leak_oid, '{lk-' || cast(o_orderkey as string) || '}' as leak_key_raw,
  cast((o_orderkey*6151) % 184000 as double) + cast(0.25 as double) as x,
  cast((o_orderkey*12289) % 184000 as double) + cast(0.5 as double) as y,
  case when o_orderkey % 5 = 0 then 'NY' else 'MA' end as jurisdiction
from orders"""

SUPPLEMENTAL = """
select 'LK-' || cast(o_orderkey as string) as LeakNumber, 0 as ordinal,
  case when o_custkey % 23 = 0 then '' else cast(2*(1 + o_custkey % 4) as string) || ' in' end as Diameter,
  case o_custkey % 16 when 0 then 'Plastic PE' when 1 then 'cast-iron' when 2 then 'Coated  Steel' when 3 then 'COPPER' when 4 then 'HDPE' when 5 then 'Bare Steel' when 6 then 'Wrought Iron' when 7 then 'Polyethylene' when 8 then 'Unknown' when 9 then '9' when 10 then 'Brass' when 11 then 'null' when 12 then 'Steel Pipe' when 13 then '12 in' when 14 then ' Ductile Iron ' else 'Copper Tubing' end as LeakMaterialType,
  case o_orderkey % 4 when 0 then 'Service Line' when 1 then 'Main' when 2 then '' else 'Unknown' end as FacilityType,
  case o_custkey % 3 when 0 then 'LP' when 1 then 'hp' else '' end as Pressure
from orders where o_orderkey % 17 <> 0
union all
select 'lk-' || cast(o_orderkey as string), 1, '4', 'Copper', 'Main', 'LP' from orders where o_orderkey % 50 = 1"""

PIPES = """
select ((l_orderkey*10 + l_linenumber)*100000 + l_partkey)*1000 + l_suppkey as pipe_oid,
  case when l_partkey % 2 = 0 then 'distribution' else 'service' end as layer,
  1 + l_partkey % 2 as assetgroup,
  case when l_partkey % 29 = 0 then null else l_partkey % 17 end as assettype,
  case when l_suppkey % 31 = 0 then null else cast(1 + l_suppkey % 4 as double)*2 end as nominaldiameter,
  case l_suppkey % 3 when 0 then 'LP' when 1 then 'HP' else '' end as operatingpressure,
  cast((l_orderkey*7919 + l_linenumber*104729) % 184000 as double) as x1,
  cast((l_orderkey*15485863 + l_linenumber*1299709) % 184000 as double) as y1,
  cast((l_partkey*37) % 400 - 200 as double) as dx, cast((l_partkey*91) % 400 - 200 as double) as dy
from lineitem"""

SEGMENTS_SPARK = """
select pipe_oid, layer, assettype, nominaldiameter, operatingpressure, 0 as path_idx,
  inline(array(named_struct('seg_idx', 0, 'ax', x1, 'ay', y1, 'bx', x1+dx, 'b_y', y1+dy), named_struct('seg_idx', 1, 'ax', x1+dx, 'ay', y1+dy, 'bx', x1+dx+dy, 'b_y', y1+dy-dx)))
from pipes"""

#: The same rows in SQL that DuckDB reads too.
SEGMENTS = """
select pipe_oid, layer, assettype, nominaldiameter, operatingpressure, 0 as path_idx, 0 as seg_idx, x1 as ax, y1 as ay, x1+dx as bx, y1+dy as b_y from pipes
union all
select pipe_oid, layer, assettype, nominaldiameter, operatingpressure, 0, 1, x1+dx, y1+dy, x1+dx+dy, y1+dy-dx from pipes"""

GROUPS = {1: "Distribution Main", 2: "Service"}


def view(spark: SparkSession, sf_dir: str, *tables: str) -> None:
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    view(spark, sf_dir, "orders")
    return spark.sql(LEAKS)


def raw_supplemental(spark: SparkSession, sf_dir: str) -> DataFrame:
    view(spark, sf_dir, "orders")
    return spark.sql(SUPPLEMENTAL)


def pipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    view(spark, sf_dir, "lineitem")
    return spark.sql(PIPES)


def segment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with the prepared pipe columns that matching needs."""
    pipes(spark, sf_dir).createOrReplaceTempView("pipes")
    s = with_rules(spark.sql(SEGMENTS_SPARK), "assettype", MATERIAL_RULES)
    return s.select("pipe_oid", "layer", "material", "label", "family", s.nominaldiameter.alias("diameter"), s.operatingpressure.alias("pressure"), "path_idx", "seg_idx", "ax", "ay", "bx", "b_y")


def tasks_with_gid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks with a global id; every 40th leak comes twice, at first in another place."""
    one = leaks(spark, sf_dir).withColumn("leak_gid", F.concat(F.lit("{L-"), F.col("leak_oid").cast("string"), F.lit("}")))
    first = one.filter("leak_oid % 40 = 0").withColumn("x", F.col("x") + 900).withColumn("leak_gid", F.lit("{old}"))
    ready = leak_tasks(gated_leaks(one.unionByName(first), supplemental(raw_supplemental(spark, sf_dir))))
    return ready.withColumn("seen", (F.col("leak_gid") != "{old}").cast("int"))


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated_leaks(leaks(spark, sf_dir), supplemental(raw_supplemental(spark, sf_dir)))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_tasks(gated(spark, sf_dir))


def decoder_table(spark: SparkSession) -> DataFrame:
    """The decoder of the two subtypes, as built from layer metadata."""
    values = [(str(k), v) for k, v in LABELS.items()]
    types = [(str(g), name, {"ASSETTYPE": ("Material", values)}) for g, name in GROUPS.items()]
    return decoder(spark.createDataFrame([("ASSETGROUP", types)], DOMAIN_SCHEMA))


def coded_pipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipes(spark, sf_dir).withColumnsRenamed({"assetgroup": "ASSETGROUP", "assettype": "ASSETTYPE"})


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_pipes(coded_pipes(spark, sf_dir), decoder_table(spark))
