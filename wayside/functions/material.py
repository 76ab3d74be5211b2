"""Material labels and families as Column functions, driven by term tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayside.functions.text import clean, let, parse_number, upper

# Subtype codes of the service pipe domain.
LABELS = {
    0: "Unknown",
    1: "Bare Steel",
    2: "Cast Iron",
    3: "Coated Steel",
    4: "Composite",
    5: "Copper",
    6: "Ductile Iron",
    7: "Plastic ABS",
    8: "Plastic Other",
    9: "Plastic PE",
    10: "Plastic PVC",
    11: "Reconditioned Cast Iron",
    12: "Wrought Iron",
    13: "Polybutylene",
    14: "Reconditioned Steel",
    15: "Galvanized Steel",
    999: "UNK",
}
# Terms by family, tested in this order. Three sets that differ on purpose:
# for matching, for a decoded row label, and for the viewer's map.
MATCH_TERMS = {
    "PLASTIC": ["PLASTIC", "POLY", "PE", "PVC", "ABS", "POLYBUTYLENE", "HD", "MD", "HDPE", "MDPE"],
    "IRON": ["CAST IRON", "DUCTILE", "WROUGHT IRON", "RECONDITIONED CAST"],
    "STEEL": ["STEEL", "BARE STEEL", "COATED STEEL", "GALVANIZED", "RECONDITIONED STEEL"],
    "COPPER": ["COPPER"],
    "UNKNOWN": ["UNKNOWN", "UNK", "COMPOSITE", "NULL", "NONE"],
}
ROW_TERMS = {
    "PLASTIC": ["PLASTIC", "POLY", "PE", "PVC", "ABS", "HDPE", "MDPE"],
    "IRON": ["CAST IRON", "DUCTILE", "WROUGHT", "IRON"],
    "STEEL": ["STEEL", "GALVANIZED", "BARE", "COATED"],
    "COPPER": ["COPPER"],
    "UNKNOWN": ["UNKNOWN", "UNK", "COMPOSITE"],
}
VIEWER_TERMS = {
    "PLASTIC": ["PLASTIC", "POLY", "PE", "PVC", "ABS", "HDPE", "MDPE", "POLYBUTYLENE"],
    "IRON": ["CAST IRON", "DUCTILE", "WROUGHT", "IRON", "CI", "WI"],
    "STEEL": ["STEEL", "GALVANIZED", "BARE", "COATED", "ST"],
    "COPPER": ["COPPER", "CU"],
    "UNKNOWN": ["UNKNOWN", "UNK", "COMPOSITE", "UN"],
}
# Display colours.
COLORS = {"PLASTIC": "#f7e708f0", "STEEL": "#061FFAF6", "IRON": "#8b4513", "COPPER": "#b87333", "UNKNOWN": "#D30FFAEB", "OTHER": "#7b68ee"}
LAYER_COLORS = {"distribution": "#0066cc", "service": "#00a651", "": "#d40000"}
#: Distinct texts up to which a rule is applied to them alone and joined back.
FEW_TEXTS = 4096
#: Terms of at least this many letters also match the start of a token.
PREFIX_LETTERS = 4


def material_label(c: Column | str) -> Column:
    """The label of a known subtype code (any text whose first number is one), else the cleaned text."""
    table = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    code = let(parse_number(c), lambda n: F.when((n == F.floor(n)) & (F.abs(n) < 1e6), n.cast("int")))
    return F.coalesce(F.element_at(table, code), clean(c))


def padded_tokens(label: Column) -> Column:
    """A label's upper-case tokens between single spaces, with a space at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(upper(label), "[^A-Z0-9]+", " ")), F.lit(" "))


def _holds(padded: Column, term: str) -> Column:
    """Whole tokens in a row; a long single term may also start a token."""
    open_end = " " not in term and len(term) >= PREFIX_LETTERS
    return padded.contains(f" {term}" if open_end else f" {term} ")


def _first_family(padded: Column, terms: dict[str, list[str]]) -> Column:
    """The first family one of whose terms is held, else null."""

    def pick(p: Column) -> Column:
        hits = [(family, reduce(lambda a, b: a | b, [_holds(p, w) for w in words])) for family, words in terms.items()]
        return F.coalesce(*[F.when(hit, family) for family, hit in hits])

    return let(padded, pick)


def material_family(c: Column | str) -> Column:
    """Compatibility family for matching; a label of no family stands for itself, blank stays blank."""
    return let(material_label(c), lambda label: F.coalesce(_first_family(padded_tokens(label), MATCH_TERMS), upper(label)))


def row_family(c: Column | str) -> Column:
    """Family of a decoded row label: OTHER if none, UNKNOWN if it has no token."""
    return let(padded_tokens(material_label(c)), lambda p: F.when(F.trim(p) == "", "UNKNOWN").otherwise(F.coalesce(_first_family(p, ROW_TERMS), F.lit("OTHER"))))


def viewer_family(c: Column | str) -> Column:
    """The map viewer's family; codes are not decoded there."""
    text = F.upper(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")))
    padded = F.concat(F.lit(" "), F.trim(F.regexp_replace(text, "[^A-Z0-9]+", " ")), F.lit(" "))
    return let(padded, lambda p: F.when(F.trim(p) == "", "UNKNOWN").otherwise(F.coalesce(_first_family(p, VIEWER_TERMS), F.lit("OTHER"))))


def substring_family(c: Column | str) -> Column:
    """The former classification by bare substrings, kept to measure the change."""
    text = F.upper(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")))
    out = None
    for family, words in ROW_TERMS.items():
        hit = reduce(lambda a, b: a | b, [text.contains(w) for w in words])
        out = F.when(hit, family) if out is None else out.when(hit, family)
    return out.when(F.trim(text) == "", "UNKNOWN").otherwise("OTHER")


def material_color(family: Column | str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in COLORS.items() for x in pair])
    return F.coalesce(F.element_at(table, F.col(family) if isinstance(family, str) else family), F.lit(COLORS["OTHER"]))


def layer_color(layer: Column | str) -> Column:
    low = F.lower(F.coalesce(F.col(layer) if isinstance(layer, str) else layer, F.lit("")))
    return F.when(low.contains("distribution"), LAYER_COLORS["distribution"]).when(low.contains("service"), LAYER_COLORS["service"]).otherwise(LAYER_COLORS[""])


def route_layers(c: Column | str) -> Column:
    """Pipe layers to search for a facility text; SERVICE is tested first."""
    t = upper(c)
    return F.when(t.contains("SERVICE"), F.array(F.lit("service"))).when(t.contains("MAIN") | t.contains("DISTRIBUTION"), F.array(F.lit("distribution"))).otherwise(F.array(F.lit("distribution"), F.lit("service")))


def search_ring(distance: Column | str, first: int = 100, step: int = 100) -> Column:
    """The ring (in steps) that would have found a match at this distance."""
    d = F.col(distance) if isinstance(distance, str) else distance
    return F.when(d <= first, F.lit(first).cast("long")).otherwise(first + step * F.ceil((d - first) / step))


def with_rules(df: DataFrame, column: str, rules: dict, few: int = FEW_TEXTS, of: DataFrame | None = None) -> DataFrame:
    """df with a column for each rule of one text column. A table has few distinct materials:
    up to `few` the rules are applied to these and broadcast back (their number is checked),
    beyond it to every row. `of` is a table with all of df's texts that is read for them instead."""
    texts = (df if of is None else of).select(F.col(column).cast("string").alias("__text")).distinct().limit(few + 1).collect()
    if len(texts) > few:
        return df.withColumns({out: rule(column) for out, rule in rules.items()})
    table = df.sparkSession.createDataFrame(texts, "__text string").select("__text", *[rule("__text").alias(out) for out, rule in rules.items()])
    return df.join(F.broadcast(table), F.col(column).cast("string").eqNullSafe(F.col("__text")), "left").drop("__text")


#: Cleaned label, its upper-case form and its compatibility family, of a raw material text.
MATERIAL_RULES = {"material": lambda c: clean(material_label(c)), "label": lambda c: upper(material_label(c)), "family": material_family}
