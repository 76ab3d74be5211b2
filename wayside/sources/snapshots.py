"""Stored layers: base files bucketed by key, change files merged on reading, and an append-only manifest.

A layer is a folder. Its rows lie in write-once parts, each a directory of Parquet files
partitioned by a bucket of the key. A manifest row names what a version consists of: for
each base part the buckets it holds, the change parts in the order in which they came, the
watermark, the counts and the reader's schema of every part. A version is there once its
manifest row is; a stop between any two writes leaves the version before, and parts that no
row names are never read. One writer at a time.

Reading takes untouched buckets as they are. In the buckets with changes, a row counts if
no later part holds its key; keys are compared as text, and rows with a null key are never
replaced. An upsert writes its changes only; compaction rewrites the touched buckets only.

Buckets hold about BUCKET_ROWS rows, so their number grows with the layer. The driver
reads the newest manifest row; it is as long as there are buckets and parts.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayside.functions.text import epoch_ms

BUCKET_ROWS = 1 << 20
MOST_CHANGES = 8
BUCKET = "__bucket"

MANIFEST = "turn long, version string, url string, where_clause string, modified_field string, max_modified_ms long, source_count long, n long, stream string, batch_id long, cached_utc timestamp"


@dataclass(frozen=True)
class Part:
    name: str
    buckets: tuple[int, ...]
    schema: str


@dataclass(frozen=True)
class Version:
    """What a version consists of: parts of the base, then changes; key and buckets are null for a layer without a key."""

    base: tuple[Part, ...] = ()
    changes: tuple[Part, ...] = ()
    key: str | None = None
    buckets: int = 1

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(text: str) -> Version:
        v = json.loads(text)
        parts = lambda ps: tuple(Part(p["name"], tuple(p["buckets"]), p["schema"]) for p in ps)
        return Version(parts(v["base"]), parts(v["changes"]), v["key"], v["buckets"])


@dataclass
class Layer:
    """A stored layer of a folder, for one url and filter."""

    spark: SparkSession
    folder: str
    url: str
    where: str
    bucket_rows: int = BUCKET_ROWS
    most_changes: int = MOST_CHANGES

    # -- the manifest --

    def newest(self) -> dict | None:
        """The newest manifest row of the folder, of whatever url and filter, with its age."""
        try:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest")
            row = rows.withColumn("age_seconds", F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("cached_utc")).orderBy(F.desc("turn"), F.desc("cached_utc")).first()
        except AnalysisException:
            return None
        return row.asDict() if row else None

    def meta(self) -> dict | None:
        """The newest manifest row, if it is of this url and filter."""
        row = self.newest()
        return row if row and (row["url"], row["where_clause"]) == (self.url, self.where) else None

    def _commit(self, version: Version, modified: str | None, mark: int | None, source_count: int | None, n: int, stream: str | None = None, batch_id: int | None = None) -> None:
        known = self.newest()
        values = [(known["turn"] + 1 if known else 0, version.text(), self.url, self.where, modified, mark, source_count, n, stream, batch_id)]
        schema = T.StructType(T._parse_datatype_string(MANIFEST).fields[:-1])
        row = self.spark.createDataFrame(values, schema).withColumn("cached_utc", F.current_timestamp())
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    # -- parts --

    def _bucket(self, key: str | None, buckets: int) -> Column:
        """The bucket of a row; rows without a key, which never meet, are spread."""
        if key is None:
            return F.lit(0)
        name = F.when(F.col(key).isNull(), F.to_json(F.struct("*"))).otherwise(F.col(key).cast("string"))
        return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, key: str | None, buckets: int) -> Part:
        """A part with these rows, and the buckets it holds."""
        name = f"part-{uuid.uuid4().hex}"
        dealt = rows.withColumn(BUCKET, self._bucket(key, buckets))
        if buckets > 1:
            dealt = dealt.hint("rebalance", BUCKET)
        dealt.write.partitionBy(BUCKET).parquet(f"{self.folder}/{name}")
        part = Part(name, (), rows.schema.json())
        return replace(part, buckets=tuple(sorted(r[0] for r in self._read(part).select(BUCKET).distinct().collect())))

    def _read(self, part: Part) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(part.schema))
        nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + [T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(nullable).parquet(f"{self.folder}/{part.name}")

    def _rows(self, version: Version, wanted: set[int] | None = None) -> DataFrame | None:
        """The version's rows with their bucket (of the wanted buckets, or all)."""
        within = lambda p: [b for b in p.buckets if wanted is None or b in wanted]
        touched = {b for p in version.changes for b in within(p)}
        still = lambda df, buckets: df.filter(F.col(BUCKET).isin(buckets))
        out = [still(self._read(p), [b for b in within(p) if b not in touched]) for p in version.base]
        if touched:
            parts = [*version.base, *version.changes]
            aged = [still(self._read(p), [b for b in within(p) if b in touched]).withColumn("__turn", F.lit(i)) for i, p in enumerate(parts)]
            late = aged[len(version.base) :]
            text = F.col(version.key).cast("string").alias("__key")
            last = reduce(DataFrame.unionByName, [a.select(text, "__turn") for a in late]).filter("__key is not null").groupBy("__key").agg(F.max("__turn").alias("__last"))
            every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aged).withColumn("__key", F.col(version.key).cast("string"))
            out.append(every.join(last, "__key", "left").filter("__last is null or __turn >= __last").drop("__key", "__turn", "__last"))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out) if out else None

    # -- reading and writing --

    def read(self, buckets: set[int] | None = None) -> DataFrame | None:
        """The current rows; none if the layer is absent or of another url or filter."""
        meta = self.meta()
        return None if meta is None else self._rows(Version.of(meta["version"]), buckets).drop(BUCKET)

    def touched(self, rows: DataFrame, key: str) -> set[int] | None:
        """The buckets of these rows' keys; None (all) if the layer is not stored by this key."""
        version = Version.of(self.meta()["version"])
        return {r[0] for r in rows.select(self._bucket(key, version.buckets)).distinct().collect()} if version.key == key else None

    def store(self, rows: DataFrame, key: str | None = None, modified: str | None = None, mark: int | None = None, source_count: int | None = None, stream: str | None = None, batch_id: int | None = None) -> None:
        """Store rows as the whole layer. The mark is the latest modification among them, unless given."""
        buckets = 1 if key is None else max(1, -(-rows.count() // self.bucket_rows))
        part = self._write(rows, key, buckets)
        found, n = self._marked(part, modified)
        self._commit(Version((part,), (), key, buckets), modified, found if mark is None else mark, source_count, n, stream, batch_id)

    def _marked(self, part: Part, modified: str | None) -> tuple[int | None, int]:
        rows = self._read(part)
        mark = F.max(epoch_ms(modified)) if modified and modified in rows.columns else F.lit(None).cast("long")
        row = rows.agg(mark.alias("mark"), F.count("*").alias("n")).first()
        return row["mark"], row["n"]

    def upsert(self, changes: DataFrame, key: str, modified: str | None = None, source_count: int | None = None, expected: int | None = None, stream: str | None = None, batch_id: int | None = None) -> bool:
        """Put changes in place of the rows with their keys. If `expected` is given and is not the
        number of rows that results, nothing is changed and the answer is False."""
        meta = self.meta()
        version = Version.of(meta["version"])
        if version.key != key:  # stored without this key: dealt anew once
            rows = self._rows(version).drop(BUCKET)
            buckets = max(1, -(-meta["n"] // self.bucket_rows))
            version = Version((self._write(rows, key, buckets),), (), key, buckets)
        part = self._write(changes, key, version.buckets)
        mark, added = self._marked(part, modified)
        touched = set(part.buckets)
        old = self._rows(version, touched) if touched else None
        ids = self._read(part).select(F.col(key).cast("string").alias("__key")).filter("__key is not null").distinct()
        gone = old.select(F.col(key).cast("string").alias("__key")).join(ids, "__key", "left_semi").count() if old is not None else 0
        n = meta["n"] - gone + added
        if expected is not None and n != expected:
            return False
        marks = [m for m in (meta["max_modified_ms"], mark) if m is not None]
        version = replace(version, changes=(*version.changes, part)) if added else version
        if len(version.changes) > self.most_changes:
            version = self.compacted(version)
        self._commit(version, modified or meta["modified_field"], max(marks) if marks else None, source_count, n, stream, batch_id)
        return True

    def compacted(self, version: Version) -> Version:
        """The same rows with the touched buckets written anew; other buckets stay where they are."""
        touched = {b for p in version.changes for b in p.buckets}
        rows = self._rows(version, touched).drop(BUCKET)
        kept = [replace(p, buckets=tuple(b for b in p.buckets if b not in touched)) for p in version.base]
        return replace(version, base=(*[p for p in kept if p.buckets], self._write(rows, version.key, version.buckets)), changes=())

    def compact(self) -> None:
        """Compaction as a version of its own: same rows, watermark and counts."""
        meta = self.meta()
        version = Version.of(meta["version"])
        if version.changes:
            self._commit(self.compacted(version), meta["modified_field"], meta["max_modified_ms"], meta["source_count"], meta["n"], meta["stream"], meta["batch_id"])
