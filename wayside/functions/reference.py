"""The reference system of a layer as metadata of its geometry columns.

A system is known by its number: DEGREES, or NATIVE for the layers' own projected feet. It
travels with a column through selects, renames, filters, joins and Parquet files, and costs
nothing per row. A layer without one gets it assigned; a layer that has another one keeps it
unless it is overridden; layers meet in one system only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.functions.geometry import to_degrees, to_native

DEGREES, NATIVE = 4326, 102_000_001
KEY = "wkid"


def _geometry(df: DataFrame) -> list[str]:
    """The geometry columns of a layer: paths, or x and y."""
    found = ["paths"] if "paths" in df.columns else [c for c in ("x", "y") if c in df.columns]
    if not found or len(found) == 1 and found != ["paths"]:
        raise ValueError(f"no geometry (paths, or x and y) among {df.columns}")
    return found


def system_of(df: DataFrame) -> int | None:
    """The layer's system; none if it is not known. Columns that disagree are an error."""
    known = {df.schema[c].metadata.get(KEY) for c in _geometry(df)}
    if len(known) > 1:
        raise ValueError(f"the geometry columns are of several systems: {sorted(map(str, known))}")
    return known.pop()


def _tagged(df: DataFrame, wkid: int) -> DataFrame:
    for c in _geometry(df):
        df = df.withMetadata(c, {**df.schema[c].metadata, KEY: wkid})
    return df


def assign_system(df: DataFrame, wkid: int, override: bool = False) -> DataFrame:
    """Say in which system a layer's coordinates are; they stay as they are."""
    known = system_of(df)
    if known == wkid:
        return df
    if known is not None and not override:
        raise ValueError(f"the layer is in system {known}; override to call it {wkid}")
    return _tagged(df, wkid)


def to_system(df: DataFrame, wkid: int) -> DataFrame:
    """A layer in another system. In the same one it is the same DataFrame; null and empty geometry stays so."""
    known = system_of(df)
    if known is None:
        raise ValueError("the layer's system is not known: assign one first")
    if known == wkid:
        return df
    ways = {(DEGREES, NATIVE): to_native, (NATIVE, DEGREES): to_degrees}
    if (known, wkid) not in ways:
        raise ValueError(f"no way from system {known} to {wkid}")
    turn = ways[known, wkid]

    def vertex(v: Column) -> Column:
        x, y = turn(v["x"], v["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    if _geometry(df) == ["paths"]:
        df = df.withColumn("paths", F.transform("paths", lambda p: F.transform(p, vertex)))
    else:
        x, y = turn(F.col("x"), F.col("y"))
        df = df.withColumns({"x": x, "y": y})
    return _tagged(df, wkid)


def require_same_system(*layers: DataFrame) -> int | None:
    """The one system of layers that are to meet; several are an error."""
    known = {system_of(d) for d in layers}
    if len(known) > 1:
        raise ValueError(f"layers of different systems meet: {sorted(map(str, known))}")
    return known.pop() if known else None


def in_one_system(leading: DataFrame, *layers: DataFrame) -> list[DataFrame]:
    """All layers in the system of the leading one (its own coordinates stay)."""
    wkid = system_of(leading)
    if wkid is None:
        raise ValueError("the leading layer's system is not known")
    return [leading, *[to_system(d, wkid) for d in layers]]
