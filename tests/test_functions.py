"""Text, number, code and material functions: one DataFrame for each table of cases."""

import pytest
from pyspark.sql import functions as F

from wayside.functions import material as M
from wayside.functions import text as T

CASES = {
    "clean": (T.clean, [(None, ""), ("", ""), ("  ", ""), ("None", ""), ("NULL", ""), ("nan", ""), (" a  b\tc ", "a b c"), ("nullable", "nullable"), (" x ", "x")]),
    "upper": (T.upper, [("cast–iron", "CAST-IRON"), ("a—b", "A-B"), (None, "")]),
    "normalize_key": (T.normalize_key, [("{lk-12}", "LK-12"), ("12.0", "12"), ("12.50", "12.50"), ("-12.0", "-12.0"), (" {ab} ", "AB"), (None, "")]),
    "viewer_key": (T.viewer_key, [("{lk-12}", "{LK-12}"), ("x.0", "X"), ("12.0", "12"), (" a ", "A"), (None, "")]),
    "parse_number": (T.parse_number, [("12 in", 12.0), ("1,200", 1.0), ("-3", -3.0), ("2.0", 2.0), ("", None), ("null", None), ("abc", None), ("+4.5x", 4.5), (None, None), (".5", 5.0)]),
    "norm_code": (T.norm_code, [("5.0", "5"), ("-5.0", "-5"), (" 7 ", "7"), ("", None), (None, None), ("a.0", "a.0")]),
    "audit_text": (T.audit_text, [(" Steel ", "STEEL"), ("nan", ""), ("None", ""), (None, "")]),
    "short_code": (T.short_code, [("CI", True), ("UNK", True), ("Cast", False), ("", False), (None, False), (" A", False)]),
    "label": (M.material_label, [("9", "Plastic PE"), ("12 in", "Wrought Iron"), ("Plastic 2", "Cast Iron"), ("16", "16"), ("2.5", "2.5"), (" Steel  Pipe ", "Steel Pipe"), ("999", "UNK"), (None, ""), ("1e300", "Bare Steel"), ("9" * 400, "9" * 400)]),
    "family": (
        M.material_family,
        [
            ("COPPER", "COPPER"), ("Plastic PE", "PLASTIC"), ("HDPE", "PLASTIC"), ("Polyethylene", "PLASTIC"), ("cast-iron", "IRON"), ("Steel Pipe", "STEEL"), ("Iron", "IRON"), ("Wrought", "WROUGHT"), ("Coated", "COATED"),
            ("Coated Plastic", "PLASTIC"), ("Brass", "BRASS"), ("", ""), ("null", ""), ("Unknown", "UNKNOWN"), ("12 in", "IRON"), ("Reconditioned Cast Iron", "IRON"), ("CASTIRON", "CASTIRON"), ("Ductiles", "IRON"), ("PET", "PET"), (None, ""),
        ],
    ),
    "row_family": (M.row_family, [("Iron", "IRON"), ("Wrought", "IRON"), ("Coated", "STEEL"), ("Bare", "STEEL"), ("Brass", "OTHER"), ("", "UNKNOWN"), (None, "UNKNOWN"), ("--", "UNKNOWN"), ("Copper", "COPPER"), ("Composite", "UNKNOWN"), ("HD", "OTHER")]),
    "viewer_family": (M.viewer_family, [("CI", "IRON"), ("WI", "IRON"), ("ST", "STEEL"), ("CU", "COPPER"), ("UN", "UNKNOWN"), ("9", "OTHER"), ("", "UNKNOWN"), (None, "UNKNOWN"), ("STX", "OTHER")]),
    "substring_family": (M.substring_family, [("COPPER", "PLASTIC"), ("Steel", "STEEL"), ("", "UNKNOWN"), ("Brass", "OTHER"), (None, "UNKNOWN")]),
    "route": (lambda c: F.array_join(M.route_layers(c), ","), [("Service Line", "service"), ("Main", "distribution"), ("distribution", "distribution"), ("Service Main", "service"), ("", "distribution,service"), (None, "distribution,service")]),
    "iso": (T.epoch_ms_to_iso, [("1640995200000", "2022-01-01T00:00:00Z"), ("", ""), (None, ""), ("not a date", "not a date")]),
    "watermark": (lambda c: F.date_format(T.safe_watermark(c), "yyyy-MM-dd HH:mm:ss"), [("1640995200999", "2022-01-01 00:00:00"), ("0", "1970-01-01 00:00:00"), ("-1", "1970-01-01 00:00:00"), ("x", "1970-01-01 00:00:00"), (None, "1970-01-01 00:00:00"), ("99999999999999", "1970-01-01 00:00:00"), ("Infinity", "1970-01-01 00:00:00")]),
    "epoch": (T.epoch_ms, [("1640995200000", 1640995200000), ("-5", -5), ("2022-01-01", 2022), ("garbage", None), (None, None), ("", None)]),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    function, cases = CASES[name]
    rows = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v string").select("i", function("v").alias("out")).orderBy("i").collect()
    assert [r.out for r in rows] == [want for _, want in cases]


def test_search_ring(spark):
    cases = [(-1.0, 100), (0.0, 100), (100.0, 100), (100.1, 200), (200.0, 200), (200.5, 300), (3000.0, 3000), (None, None)]
    rows = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v double").select("i", M.search_ring("v").alias("out")).orderBy("i").collect()
    assert [r.out for r in rows] == [w for _, w in cases]


def test_numbers_and_colors(spark):
    row = spark.createDataFrame([(float("nan"), 2.5, "IRON", "x")], "a double, b double, f string, g string").select(T.number_or_null("a"), T.number_or_null("b"), M.material_color("f"), M.material_color("g"), M.layer_color("g")).first()
    assert tuple(row) == (None, 2.5, "#8b4513", "#7b68ee", "#d40000")


DOUBLES = [1e7, 12345678.0, 1.7e12, 1e16, 12345678.5, -2.5e8, 5.0, 0.0001, float("nan"), float("inf"), None]


def test_text_of_doubles(spark):
    """Keys, numbers, codes and dates from double columns, also beyond 10^7."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(DOUBLES)], "i int, v double").orderBy("i")
    out = lambda f: [r[0] for r in df.select(f("v"), "i").orderBy("i").collect()]
    keys = ["10000000", "12345678", "1700000000000", "10000000000000000", "12345678.5", "-250000000.0", "5", "0.0001"]
    assert out(T.normalize_key) == [*keys, "", "INFINITY", ""]
    assert out(T.viewer_key) == [k.removesuffix(".0") for k in keys] + ["NAN", "INFINITY", ""]
    assert out(T.norm_code) == [k.removesuffix(".0") for k in keys] + ["NaN", "Infinity", None]
    assert out(T.parse_number) == [*DOUBLES[:8], None, float("inf"), None]
    assert out(T.epoch_ms) == [10**7, 12345678, 1700000000000, 10**16, 12345678, -250000000, 5, 0, None, None, None]
    assert out(lambda c: F.unix_seconds(T.safe_watermark(c))) == [10000, 12345, 1700000000, 0, 12345, 0, 0, 0, 0, 0, 0]


def test_numbers_of_other_kinds(spark):
    row = spark.sql("select 7 as i, float(2.5) as f, decimal(12.50) as d, true as t, false as b, '1e7' as s, 123456789.0F as g, timestamp'2021-01-02 03:04:05' as ts, date'2021-01-02' as day")
    assert tuple(row.select(*[T.parse_number(c) for c in "ifdtb"]).first()) == (7.0, 2.5, 13.0, 1.0, 0.0)
    assert tuple(row.select(T.parse_number("s"), T.clean("s"), T.normalize_key("g"), T.parse_number("day")).first()) == (1.0, "1e7", "123456792", 2021.0)
