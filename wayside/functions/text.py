"""Column functions that normalise text, keys, numbers, codes and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as the source data's tools see it, and the words that mean "no value".
SPACE = "[\\t-\\r\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
NO_VALUE = ("", "none", "null", "nan")
NUMBERS = "^(tinyint|smallint|int|bigint|float|double|decimal.*)$"
#: Epoch milliseconds beyond which a watermark is not believed (year 3000).
LATEST_MS = 32503680000000.0


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: Column | str) -> Column:
    """As text; doubles and floats in plain digits (12345678.0, not 1.2345678E7) up to 10^20."""
    c = _column(c)
    t = c.cast("string")
    plain = F.regexp_replace(F.regexp_replace(t.try_cast("decimal(38,18)").cast("string"), "0+$", ""), "\\.$", ".0")
    return F.when(F.typeof(c).isin("double", "float") & t.contains("E"), F.coalesce(plain, t)).otherwise(t)


def let(value: Column, use) -> Column:
    """use(value) with the value computed once: expressions that name it often stay small."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def clean(c: Column | str) -> Column:
    """Trimmed, inner white space collapsed, words for no value made '' (never null)."""
    trimmed = F.trim(F.regexp_replace(_text(c), SPACE, " "))
    return let(trimmed, lambda t: F.when(t.isNull() | F.lower(t).isin(*NO_VALUE), "").otherwise(t))


def upper(c: Column | str) -> Column:
    """clean() in upper case, with en and em dashes as hyphens."""
    return F.translate(F.upper(clean(c)), "–—", "--")


def normalize_key(c: Column | str) -> Column:
    """Join key: whole numbers lose a trailing .0, braces and outer spaces go, upper case."""
    return F.upper(F.btrim(F.regexp_replace(clean(c), "^(\\d+)\\.0$", "$1"), F.lit("{} ")))


def viewer_key(c: Column | str) -> Column:
    """The viewer's join key: any trailing .0 goes, braces stay."""
    return F.coalesce(F.upper(F.regexp_replace(F.trim(F.regexp_replace(_text(c), f"^{SPACE}|{SPACE}$", "")), "\\.0$", "")), F.lit(""))


def parse_number(c: Column | str) -> Column:
    """The first number in a text, else null; numbers as they are (NaN is null), true and false as 1 and 0."""
    c = _column(c)
    kind, t = F.typeof(c), c.cast("string")
    number = t.try_cast("double")
    found = F.regexp_extract(clean(c), "([-+]?\\d+(?:\\.\\d+)?)", 1).try_cast("double")
    return F.when(kind.rlike(NUMBERS), F.when(~F.isnan(number), number)).when(kind == "boolean", F.when(t == "true", 1.0).when(t == "false", 0.0)).otherwise(found)


def number_or_null(c: Column | str) -> Column:
    """A numeric column with NaN as null."""
    c = _column(c)
    return F.when(~F.isnan(c), c.cast("double"))


def norm_code(c: Column | str) -> Column:
    """A domain code as comparable text: 5.0 is 5, blank is null."""
    t = F.trim(F.regexp_replace(_text(c), f"^{SPACE}|{SPACE}$", ""))
    return F.when(t != "", F.regexp_replace(t, "^(-*\\d+)\\.0$", "$1"))


def audit_text(c: Column | str) -> Column:
    """Audit comparison text: trimmed upper case, NAN and NONE as blank."""
    t = F.upper(F.trim(F.coalesce(_text(c), F.lit(""))))
    return F.when(t.isin("NAN", "NONE"), "").otherwise(t)


def short_code(c: Column | str) -> Column:
    """Looks like an old grade code: 1 to 3 letters or digits. Null is not one."""
    return F.coalesce(_text(c).rlike("^[A-Za-z0-9]{1,3}$"), F.lit(False))


def epoch_ms(c: Column | str) -> Column:
    """Anything like a date as epoch milliseconds: a number in the text first, then a timestamp."""
    whole = let(parse_number(c), lambda n: F.when(F.abs(n) < 9.2e18, F.floor(F.abs(n)).cast("long") * F.signum(n).cast("long")))
    return F.coalesce(whole, F.unix_millis(F.try_to_timestamp(_text(c))))


def safe_watermark(c: Column | str) -> Column:
    """Epoch milliseconds as a UTC timestamp on whole seconds; anything unbelievable is 1970."""
    v = _text(c).try_cast("double")
    fine = v.isNotNull() & ~F.isnan(v) & (v > 0) & (v <= LATEST_MS)
    return F.timestamp_seconds(F.when(fine, F.floor(v / 1000)).otherwise(0).cast("long"))


def epoch_ms_to_iso(c: Column | str) -> Column:
    """Epoch milliseconds as ISO text; blank stays blank, what is no number stays as it is."""
    t = F.coalesce(_text(c), F.lit(""))
    return F.coalesce(F.date_format(F.timestamp_millis(t.try_cast("double").try_cast("long")), "yyyy-MM-dd'T'HH:mm:ssXXX"), t)


def json_safe(df: DataFrame) -> DataFrame:
    """Display values: timestamps and dates as ISO text, numbers that are not finite as null,
    nested and binary values as text; text, finite numbers and booleans stay."""

    def safe(field) -> Column:
        c, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        if kind.startswith("timestamp"):
            return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        if kind == "date":
            return c.cast("string")
        if kind in ("float", "double"):
            return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
        if kind.startswith(("array", "map", "struct")):
            return F.to_json(c)
        return F.base64(c) if kind == "binary" else c

    return df.select(*[safe(f).alias(f.name) for f in df.schema.fields])
