"""A Python data source over a paged feature service (here: a folder of page files).

A layer is fetched by as many tasks as it has pages (of more than TASKS pages a task fetches
several), and a lost task fetches its pages again. Pages that were written with an index (write_pages) hold ranges of ids or dates:
wanted ids and, in the format `indexed_features`, filters on the id and date columns that
Spark pushes down leave out the pages whose ranges they miss, before any page is opened.
Every page is opened once at most.

Options: path; idField and dateField (columns of the index's ranges); ids (optional list of
wanted ids, comma separated; other text in it is skipped). A schema column `page_number`
is filled with the page's number. Rows without geometry are left out; Spark applies the
pushed filters again to every row. The folder has to be mounted on all machines. The driver reads one index line a page.
"""

from __future__ import annotations

import glob
import gzip
import json
import time
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from wayside.sources.pages import stored

RETRY_DELAYS = (2, 5, 15)
PAGE_ROWS = 2000
#: Up to so many pages are a task each.
TASKS = 2048


def write_pages(rows: DataFrame, by: str, ranges: dict[str, str], feature: Column, folder: str, size: int = PAGE_ROWS) -> None:
    """Features as page files of about `size` each, in ranges of a column, and their index: for every
    page its rows and the least and largest value of the columns in `ranges` (name in the index: column).

    A row's page follows from the rows with smaller values and, among equal ones, from a hash, so that a
    value of many rows fills several pages. Rows are stored once and shuffled once, to their page."""
    rows = stored(rows)  # dealt once: the pages and their index have to agree
    before = _before(rows, by).withColumnRenamed(by, "__by")
    among = F.pmod(F.xxhash64(*dict.fromkeys([by, *ranges.values()])), F.col("__n"))
    dealt = rows.join(before, F.col(by).eqNullSafe(F.col("__by"))).withColumn("page", F.floor((F.col("__before") + among) / size).cast("int")).drop("__by", "__n", "__before")
    texts = dealt.repartition("page").groupBy("page").agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value"))
    texts.write.partitionBy("page").option("compression", "gzip").text(f"{folder}/pages")
    ends = [f(c).alias(f"{side}_{name}") for name, c in ranges.items() for side, f in (("first", F.min), ("last", F.max))]
    dealt.groupBy("page").agg(F.count("*").alias("n"), *ends).coalesce(1).write.json(f"{folder}/index")


def _before(rows: DataFrame, by: str) -> DataFrame:
    """(by, __n, __before) of every value of a column: its rows and those of smaller values. Values are summed up
    within ranges of them, and the ranges, of which there are as many as shuffle partitions at most, among themselves."""
    counts = stored(rows.groupBy(by).agg(F.count("*").alias("__n")).repartitionByRange(by).withColumn("__range", F.spark_partition_id()))
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    base = counts.groupBy("__range").agg(F.sum("__n").alias("__in")).withColumn("__base", F.coalesce(F.sum("__in").over(ahead(Window.orderBy("__range"))), zero))
    within = F.coalesce(F.sum("__n").over(ahead(Window.partitionBy("__range").orderBy(by))), zero)
    return counts.withColumn("__within", within).join(F.broadcast(base), "__range").select(by, "__n", (F.col("__base") + F.col("__within")).alias("__before"))


class Pages(InputPartition):
    """Pages that one task fetches: (number, file)."""

    def __init__(self, pages: list[tuple[int, str]]):
        self.pages = pages


def shared_out(pages: list[tuple[int, str]]) -> list[Pages]:
    """A task a page, or of very many pages neighbouring ones in about TASKS tasks."""
    n = max(1, -(-len(pages) // TASKS))
    return [Pages(pages[i : i + n]) for i in range(0, len(pages), n)]


def local(path: str) -> str:
    return "/" + path[len("file:") :].lstrip("/") if path.startswith("file:") else path


class FeatureReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.names = [f.name for f in schema.fields]
        self.path = local(options["path"])
        self.key = options.get("idfield", options.get("idField", "OBJECTID"))
        self.columns = {"id": self.key, "date": options.get("datefield", options.get("dateField"))}
        wanted = options.get("ids", "")
        self.ids = {int(x) for x in wanted.split(",") if x.strip().lstrip("-").isdigit()} if wanted.strip() else None
        self.tests: list[tuple[str, object]] = []  # (name in the index, whether a range may pass)

    def partitions(self) -> list[Pages]:
        index = sorted(glob.glob(f"{self.path}/index/*.json"))
        if not index:
            return shared_out(list(enumerate(sorted(glob.glob(f"{self.path}/*.json")))))
        out = []
        for line in (line for file in index for line in open(file, encoding="utf-8")):
            entry = json.loads(line)
            span = lambda name: (entry.get(f"first_{name}"), entry.get(f"last_{name}"))  # noqa: B023, E731
            passes = all(test(*span(name)) for name, test in self.tests if None not in span(name))  # noqa: B023
            lo, hi = span("id")
            if passes and (self.ids is None or lo is None or any(lo <= i <= hi for i in self.ids)):
                out += [(entry["page"], f) for f in glob.glob(f"{self.path}/pages/page={entry['page']}/*.txt*")]
        return shared_out(sorted(out))

    def read(self, partition: Pages) -> Iterator[tuple]:
        for number, file in partition.pages if partition else ():  # none: no page is left to be opened
            for feature in fetch(file).get("features", []):
                row = feature.get("attributes", {})
                if feature.get("geometry") and (self.ids is None or row.get(self.key) in self.ids):
                    yield tuple(number if n == "page_number" else json.dumps(feature["geometry"]) if n == "geometry" else row.get(n) for n in self.names)


class PushingReader(FeatureReader):
    """A reader that leaves out pages by the filters that Spark pushes down."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = next((n for n, c in self.columns.items() if getattr(f, "attribute", None) == (c,)), None)
            ways = {
                EqualTo: lambda lo, hi, v: lo <= v <= hi, In: lambda lo, hi, v: any(lo <= x <= hi for x in v if x is not None),
                GreaterThan: lambda lo, hi, v: hi > v, GreaterThanOrEqual: lambda lo, hi, v: hi >= v, LessThan: lambda lo, hi, v: lo < v, LessThanOrEqual: lambda lo, hi, v: lo <= v,
            }
            if name and type(f) in ways and f.value is not None:
                self.tests.append((name, lambda lo, hi, way=ways[type(f)], v=f.value: way(lo, hi, v)))
            yield f


def fetch(path: str, delays: tuple[float, ...] = RETRY_DELAYS) -> dict:
    """One page, with pauses between attempts."""
    for delay in (*delays, None):
        try:
            with (gzip.open if path.endswith(".gz") else open)(path, "rt", encoding="utf-8") as f:
                return json.load(f)
        except (OSError, EOFError, json.JSONDecodeError):
            if delay is None:
                raise
            time.sleep(delay)
    raise AssertionError


class FeatureSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "features"

    def reader(self, schema) -> FeatureReader:
        return FeatureReader(schema, self.options)


class IndexedFeatureSource(FeatureSource):
    """The same pages with filters pushed down; needs spark.sql.python.filterPushdown.enabled."""

    @classmethod
    def name(cls) -> str:
        return "indexed_features"

    def reader(self, schema) -> PushingReader:
        return PushingReader(schema, self.options)
