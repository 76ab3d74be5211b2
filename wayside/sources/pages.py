"""Feature pages (JSON) and supplemental CSV files as tables, and versioned snapshots."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayside.functions.geometry import clean_paths
from wayside.sources.snapshots import Layer

# Types of the service's fields.
FIELD_TYPES = {
    "esriFieldTypeOID": T.LongType(),
    "esriFieldTypeString": T.StringType(),
    "esriFieldTypeDouble": T.DoubleType(),
    "esriFieldTypeSingle": T.FloatType(),
    "esriFieldTypeDate": T.LongType(),
    "esriFieldTypeInteger": T.IntegerType(),
    "esriFieldTypeSmallInteger": T.ShortType(),
    "esriFieldTypeGlobalID": T.StringType(),
    "esriFieldTypeGUID": T.StringType(),
}
DEFAULT_PAGE = 2000


def layer_schema(metadata: dict) -> tuple[T.StructType, str | None, int | None, int]:
    """Attribute types, object id field, reference id (latest first) and page size of a layer."""
    fields = metadata.get("fields") or []
    schema = T.StructType([T.StructField(f["name"], FIELD_TYPES.get(f.get("type"), T.StringType())) for f in fields if f.get("type") != "esriFieldTypeGeometry"])
    oid = metadata.get("objectIdField") or next((f["name"] for f in fields if f.get("type") == "esriFieldTypeOID"), None)
    ref = (metadata.get("extent") or {}).get("spatialReference") or {}
    return schema, oid, ref.get("latestWkid") or ref.get("wkid"), min(DEFAULT_PAGE, int(metadata.get("maxRecordCount") or DEFAULT_PAGE))


def _page_schema(attributes: T.StructType) -> T.StructType:
    geometry = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()), T.StructField("paths", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))])
    return T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("attributes", attributes), T.StructField("geometry", geometry)])))])


def features(pages: DataFrame, attributes: T.StructType, text: str = "value") -> DataFrame:
    """Rows of page texts: attributes, x and y of points, paths of lines; rows without geometry go."""
    parsed = pages.select(F.from_json(text, _page_schema(attributes)).alias("p")).select(F.explode("p.features").alias("f"))
    rows = parsed.select("f.attributes.*", F.col("f.geometry.x").alias("x"), F.col("f.geometry.y").alias("y"), clean_paths(F.col("f.geometry.paths")).alias("paths"))
    return rows.filter("(x is not null and y is not null) or size(paths) > 0")


def page_texts(rows: DataFrame, key: str, feature: Column, size: int = DEFAULT_PAGE) -> DataFrame:
    """Features as page texts of about `size` each with their offsets, dealt by a hash of the key; the
    number of pages grows with the rows. All but the last say exceededTransferLimit."""
    pages = rows.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size)).alias("__pages"))
    dealt = rows.crossJoin(F.broadcast(pages)).withColumn("page", F.pmod(F.xxhash64(key), "__pages"))
    more = (F.col("page") < F.col("__pages") - 1).alias("exceededTransferLimit")
    return dealt.groupBy("page", "__pages").agg(F.to_json(F.struct(F.collect_list(feature).alias("features"), more)).alias("value")).select("page", (F.col("page") * size).alias("offset"), "value")


def fetched_pages(pages: DataFrame, attributes: T.StructType, size: int = DEFAULT_PAGE) -> DataFrame:
    """Rows of pages (`offset`, `value`) that a client stepping through offsets would see: the first
    page of under `size` features ends the layer, unless it says exceededTransferLimit. Only that
    page's offset is shared between the tasks."""
    head = F.from_json("value", "exceededTransferLimit boolean, features array<string>")
    ends = pages.select("offset", head.alias("h")).filter((F.coalesce(F.size("h.features"), F.lit(0)) < size) & ~F.coalesce("h.exceededTransferLimit", F.lit(False)))
    last = ends.agg(F.min("offset").alias("__last"))
    return features(pages.crossJoin(F.broadcast(last)).filter("__last is null or offset <= __last"), attributes)


def read_pages(spark: SparkSession, path: str, attributes: T.StructType) -> DataFrame:
    """Page files, one JSON document a file."""
    return features(spark.read.text(path, wholetext=True), attributes)


def read_supplemental(spark: SparkSession, path: str, key: str = "LeakNumber") -> DataFrame:
    """CSV with every column as text, and the rows' place as `ordinal`: file path, block of the file and
    row. Rows compare by it as they follow each other in the files, of several files in the order of
    their names, however the blocks are dealt to tasks: within a block a task reads in order."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    names = {c: c.lstrip("\ufeff").strip() for c in raw.columns}
    if key not in names.values():
        raise KeyError(f"{path}: no column {key} among {list(names.values())}")
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return raw.withColumn("ordinal", place).select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], "ordinal")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that all executors share: under spark.checkpoint.dir, or a temporary one where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    base = base or "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The table written to a scratch folder and read back."""
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def write_csv(df: DataFrame, folder: str) -> None:
    df.write.option("header", True).csv(folder)


# -- snapshots of whole tables: stored layers without a key --


def write_snapshot(df: DataFrame, folder: str, url: str, where: str, modified: str | None, max_modified_ms: int | None) -> None:
    """The next version; the mark is taken from the column `modified` unless given."""
    Layer(df.sparkSession, folder, url, where).store(df, None, modified, max_modified_ms)


def read_snapshot(spark: SparkSession, folder: str, url: str, where: str) -> DataFrame | None:
    """The current version; none if it is absent or was taken of another url or filter."""
    return Layer(spark, folder, url, where).read()


def snapshot_meta(spark: SparkSession, folder: str) -> dict | None:
    return Layer(spark, folder, "", "").newest()
