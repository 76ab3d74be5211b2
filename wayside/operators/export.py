"""Date-bounded feature export."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.functions.text import epoch_ms_to_iso
from wayside.operators.resolve import curated_columns, resolve

# Candidate names of the two dates.
INSTALL = ["installationdate", "installdate", "inservicedate"]
CREATION = ["CREATIONDATE", "created_date", "createdate"]


def date_fields(columns: Sequence[str]) -> tuple[str | None, str | None]:
    found = resolve(columns, INSTALL), resolve(columns, CREATION)
    if not any(found):
        raise RuntimeError(f"neither an installation nor a creation date among {sorted(columns)}")
    return found


def date_variants(columns: Sequence[str], day: str) -> dict[str, Column]:
    """On or after a day by either date that the layer has, for each way in which dates are written:
    epoch milliseconds, date or timestamp text, epoch seconds. A value that is not written in a way
    does not pass by it."""
    at = F.lit(day).cast("timestamp")
    text = lambda c: F.col(c).cast("string")
    number = lambda c: text(c).try_cast("double").try_cast("long")
    ways = {
        "milliseconds": lambda c: F.timestamp_millis(F.when(number(c) >= 10**11, number(c))),  # before 1973 they look like seconds
        "text": lambda c: F.when(number(c).isNull(), F.try_to_timestamp(text(c))),
        "seconds": lambda c: F.timestamp_seconds(F.when(F.abs(number(c)) < 10**11, number(c))),
    }
    fields = [c for c in date_fields(columns) if c]
    return {name: reduce(lambda a, b: a | b, [F.coalesce(way(c) >= at, F.lit(False)) for c in fields]) for name, way in ways.items()}


def choose_since(features: DataFrame, day: str) -> tuple[str, Column, int]:
    """The first way of writing dates by which rows pass (or else the first), its predicate and their
    number. All are counted in one scan that reads the dates only."""
    variants = date_variants(features.columns, day)
    counts = features.agg(*[F.count_if(v).alias(k) for k, v in variants.items()]).first()
    name = next((k for k in variants if counts[k]), next(iter(variants)))
    return name, variants[name], counts[name]


def since(columns: Sequence[str], day: str) -> Column:
    """On or after a day by either date that the layer has."""
    tests = [F.timestamp_millis(F.col(c).cast("long")) >= F.lit(day).cast("timestamp") for c in date_fields(columns) if c]
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def date_export(features: DataFrame, day: str, dates: Sequence[str] = (), curated: Sequence[str] | None = None) -> DataFrame:
    """All rows since a day, their dates as ISO text. Dates that are text are read in the first way in which rows pass."""
    texts = {f.name for f in features.schema.fields if f.dataType.typeName() == "string"}
    written = texts & {c for c in date_fields(features.columns) if c}
    rows = features.filter(choose_since(features, day)[1] if written else since(features.columns, day))
    names = curated_columns(features.columns, curated)
    rows = rows if names == ["*"] else rows.select(*names)
    return rows.withColumns({c: epoch_ms_to_iso(c) for c in dates if c in rows.columns})
