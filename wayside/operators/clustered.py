"""Line layers laid out for map views: rows near each other lie in the same file, so a view opens few files.

Every line gets its box; lines are ordered along a Z curve through the middles of their
boxes and dealt to files in ranges of it, so the number of files grows with the rows and a
file covers a small area however dense it is. An index table holds the box of every file.
A view looks up the files whose box meets it and, in those, Parquet skips the row groups
whose box columns do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayside.sources.pages import stored

FILE_ROWS = 1 << 18
#: Rows that a task lays out at least, in one file after the other.
TASK_ROWS = 1 << 16
SIDES = ("west", "south", "east", "north")


def box_columns(paths: Column) -> dict[str, Column]:
    """West, south, east and north of paths."""
    every = F.flatten(paths)
    xs, ys = F.transform(every, lambda v: v["x"]), F.transform(every, lambda v: v["y"])
    return {"west": F.array_min(xs), "south": F.array_min(ys), "east": F.array_max(xs), "north": F.array_max(ys)}


def _spread(v: Column) -> Column:
    """The lower 16 bits with a zero after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def z_value(x: Column, y: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """The place on a Z curve over a box of 65536 x 65536 cells."""
    cell = lambda v, lo, hi: F.when(hi > lo, F.least(F.floor((v - lo) / (hi - lo) * 65536), F.lit(65535))).otherwise(0).cast("long")
    return _spread(cell(x, west, east)).bitwiseOR(F.shiftleft(_spread(cell(y, south, north)), 1))


def write_clustered(lines: DataFrame, folder: str, paths: str = "paths", file_rows: int = FILE_ROWS) -> None:
    """Store lines with their boxes along the curve, and the files' index. Lines without geometry
    (null, without paths or with coordinates that are not finite) are left out."""
    spark = lines.sparkSession
    # stored, as it is read to count, to cut the curve and to be laid out
    boxed = stored(lines.filter(F.size(paths) > 0).withColumns(box_columns(F.col(paths))).filter(" and ".join(f"abs({s}) < double('Infinity')" for s in SIDES)))
    whole = boxed.agg(F.count("*").alias("__n"), *[(F.min if s in ("west", "south") else F.max)(s).alias(f"__{s}") for s in SIDES])
    tasks = max(1, -(-whole.first()["__n"] // max(file_rows, TASK_ROWS)))
    at = z_value((F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2, *[F.col(f"__{s}") for s in SIDES])
    placed = boxed.crossJoin(F.broadcast(whole)).withColumn("__z", at).drop("__n", *[f"__{s}" for s in SIDES])
    placed.repartitionByRange(tasks, "__z").sortWithinPartitions("__z").drop("__z").write.option("maxRecordsPerFile", file_rows).parquet(f"{folder}/lines")
    laid = spark.read.parquet(f"{folder}/lines")
    index = laid.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), *[(F.min if s in ("west", "south") else F.max)(s).alias(s) for s in SIDES])
    index.coalesce(1).write.parquet(f"{folder}/index")


def files_in_view(spark: SparkSession, folder: str, west: float, south: float, east: float, north: float) -> list[str]:
    """The files whose box meets a view."""
    index = spark.read.parquet(f"{folder}/index")
    return sorted(r.file for r in index.filter(_meets(west, south, east, north)).select("file").collect())


def _meets(west: float, south: float, east: float, north: float) -> Column:
    return (F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south)


def lines_near_view(spark: SparkSession, folder: str, west: float, south: float, east: float, north: float) -> DataFrame:
    """The stored lines whose box meets a view, from the files that can hold them."""
    layer = spark.read.parquet(f"{folder}/lines")
    files = files_in_view(spark, folder, west, south, east, north)
    rows = spark.read.schema(layer.schema).parquet(*files) if files else layer.limit(0)
    return rows.filter(_meets(west, south, east, north)).drop(*SIDES)
