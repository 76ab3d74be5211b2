"""DuckDB SQL for the registered queries, written apart from the Spark expressions."""

from __future__ import annotations

from wayside.functions.geometry import CENTRAL_LON, FLATTENING, SEMI_MAJOR_FT, conic_constants
from wayside.functions.material import COLORS, LABELS, MATCH_TERMS, ROW_TERMS, VIEWER_TERMS
from wayside.functions.text import SPACE
from wayside.plans.queries import BOX, RUN_UTC
from wayside.plans.workload import GROUPS, LEAKS, PIPES, SEGMENTS, SUPPLEMENTAL

RE_SPACE = SPACE.replace("\\t-\\r", "\\t\\n\\v\\f\\r")


def clean(e: str) -> str:
    t = f"trim(regexp_replace(CAST({e} AS VARCHAR), '{RE_SPACE}', ' ', 'g'))"
    return f"(CASE WHEN {e} IS NULL OR lower({t}) IN ('', 'none', 'null', 'nan') THEN '' ELSE {t} END)"


def upper(e: str) -> str:
    return f"translate(upper({clean(e)}), '–—', '--')"


def number(e: str) -> str:
    return f"try_cast(nullif(regexp_extract({clean(e)}, '([-+]?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE)"


def key(e: str) -> str:
    return f"upper(trim(regexp_replace({clean(e)}, '^(\\d+)\\.0$', '\\1'), '{{}} '))"


def view_key(e: str) -> str:
    return f"upper(regexp_replace(trim({e}), '\\.0$', ''))"


def label(e: str) -> str:
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in LABELS.items())
    return f"coalesce(CASE {number(e)} {cases} END, {clean(e)})"


def pad(e: str) -> str:
    return f"(' ' || trim(regexp_replace({e}, '[^A-Z0-9]+', ' ', 'g')) || ' ')"


def terms(padded: str, table: dict, rest: str) -> str:
    out = "CASE"
    for family, words in table.items():
        hits = " OR ".join(f"contains({padded}, ' {w}{'' if ' ' not in w and len(w) >= 4 else ' '}')" for w in words)
        out += f" WHEN {hits} THEN '{family}'"
    return f"{out} ELSE {rest} END"


def decoded(name: str, source: str, column: str) -> str:
    """CTEs that add lbl, up and fam (matching family) to a source."""
    return f"""{name}_l AS (SELECT *, {label(column)} AS lbl FROM {source}),
{name}_u AS (SELECT *, {upper('lbl')} AS up FROM {name}_l),
{name} AS (SELECT *, {terms(pad('up'), MATCH_TERMS, 'up')} AS fam, CASE WHEN trim({pad('up')}) = '' THEN 'UNKNOWN' ELSE {terms(pad('up'), ROW_TERMS, "'OTHER'")} END AS rfam FROM {name}_u)"""


BASE = f"""leaks AS ({LEAKS}), supp AS ({SUPPLEMENTAL}), pipes AS ({PIPES}), segments AS ({SEGMENTS})"""
SUPP_LAST = f"""supp_k AS (SELECT *, {key('LeakNumber')} AS leak_key FROM supp),
supp_one AS (SELECT * FROM supp_k WHERE leak_key <> '' QUALIFY row_number() OVER (PARTITION BY leak_key ORDER BY ordinal DESC, Diameter DESC, LeakMaterialType DESC, FacilityType DESC, Pressure DESC) = 1),
{decoded('supp_d', 'supp_one', 'LeakMaterialType')},
s AS (SELECT leak_key, {number('Diameter')} AS leak_diameter, {clean('lbl')} AS leak_material, {clean('Pressure')} AS leak_pressure, {clean('FacilityType')} AS facility, fam FROM supp_d)"""
GATED = f"""{SUPP_LAST},
lk AS (SELECT leak_oid, {key('leak_key_raw')} AS leak_key, x, y FROM leaks),
gated AS (SELECT lk.*, s.leak_diameter, s.leak_material, s.leak_pressure, s.facility, s.fam,
  CASE WHEN s.leak_key IS NULL THEN 'missing_supplemental' WHEN s.leak_diameter IS NULL OR s.leak_material = '' THEN 'missing_match_attributes' ELSE 'ready' END AS gate
  FROM lk LEFT JOIN s ON lk.leak_key = s.leak_key)"""
TASKS = f"""{GATED},
tasks AS (SELECT *, CASE WHEN contains({upper('facility')}, 'SERVICE') THEN ['service'] WHEN contains({upper('facility')}, 'MAIN') OR contains({upper('facility')}, 'DISTRIBUTION') THEN ['distribution'] ELSE ['distribution', 'service'] END AS allowed
  FROM gated WHERE gate = 'ready')"""


def matched(agree_leak: str = "fam", agree_pipe: str = "fam", pressure: bool = False) -> str:
    press = f"AND {upper('p.operatingpressure')} = {upper('t.leak_pressure')} AND {upper('t.leak_pressure')} <> ''" if pressure else ""
    return f"""{TASKS},
types AS (SELECT DISTINCT assettype FROM pipes), {decoded('typed', 'types', 'assettype')},
seg AS (SELECT p.*, y.lbl AS material, y.fam, y.up FROM segments p JOIN typed y ON p.assettype IS NOT DISTINCT FROM y.assettype WHERE y.lbl <> '' AND p.nominaldiameter IS NOT NULL),
tl AS (SELECT *, {upper('leak_material')} AS up, unnest(allowed) AS layer FROM tasks),
pair AS (SELECT t.leak_oid, t.x AS px, t.y AS py, p.layer, p.pipe_oid, p.path_idx, p.seg_idx, p.ax, p.ay, p.bx, p.b_y, p.material, p.nominaldiameter, p.operatingpressure,
    CASE WHEN (p.bx - p.ax)*(p.bx - p.ax) + (p.b_y - p.ay)*(p.b_y - p.ay) > 0
      THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, ((t.x - p.ax)*(p.bx - p.ax) + (t.y - p.ay)*(p.b_y - p.ay)) / ((p.bx - p.ax)*(p.bx - p.ax) + (p.b_y - p.ay)*(p.b_y - p.ay)))) ELSE 0.0::DOUBLE END AS u
  FROM tl t JOIN seg p ON t.layer = p.layer AND t.leak_diameter = p.nominaldiameter AND t.{agree_leak} = p.{agree_pipe} {press}
  WHERE greatest(p.ax, p.bx) >= t.x - 3000 AND least(p.ax, p.bx) <= t.x + 3000 AND greatest(p.ay, p.b_y) >= t.y - 3000 AND least(p.ay, p.b_y) <= t.y + 3000),
snap AS (SELECT *, ax + u*(bx - ax) AS nx, ay + u*(b_y - ay) AS ny FROM pair),
near AS (SELECT *, sqrt((px - nx)*(px - nx) + (py - ny)*(py - ny)) AS dist FROM snap),
m AS (SELECT * FROM near WHERE dist <= 3000 QUALIFY row_number() OVER (PARTITION BY leak_oid ORDER BY dist, CASE WHEN layer = 'distribution' THEN 0 ELSE 1 END, pipe_oid, path_idx, seg_idx) = 1)"""


RING = "CAST(CASE WHEN dist <= 100 THEN 100 ELSE 100 + 100 * ceil((dist - 100) / 100) END AS BIGINT)"
RELOCATED = f"""SELECT m.leak_oid AS OrigLeakOID, t.leak_key AS LeakKey, m.layer AS LinkedLayer, m.pipe_oid AS MatchedPipeOID, m.dist AS DistanceFt, {RING} AS SearchRadiusFt,
  m.material AS MatchMaterial, m.nominaldiameter AS MatchDiameter, {clean('m.operatingpressure')} AS MatchPressure, m.nx AS x, m.ny AS y FROM m JOIN tasks t ON m.leak_oid = t.leak_oid"""

DECODER = ", ".join(f"({g}, {code}, '{name}', '{text}')" for g, name in GROUPS.items() for code, text in LABELS.items())
ENRICHED = f"""dec AS (SELECT * FROM (VALUES {DECODER}) v(g, t, ASSETGROUP_DECODED, ASSETTYPE_DECODED)), {decoded('dec_f', 'dec', 'ASSETTYPE_DECODED')},
en AS (SELECT p.*, d.ASSETGROUP_DECODED, d.ASSETTYPE_DECODED, CASE WHEN d.t IS NULL THEN NULL ELSE 'Material' END AS ASSETTYPE_DOMAIN, d.rfam AS PipeMaterialFamily
  FROM pipes p LEFT JOIN dec_f d ON p.assetgroup = d.g AND p.assettype = d.t)"""


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + "\n"


def counts(column: str) -> str:
    return f"SELECT LeakMaterialType, count(*) AS n, any_value({column}) AS family FROM sd GROUP BY LeakMaterialType"


FAMILIES = with_(BASE, decoded("sd", "supp", "LeakMaterialType"))
VIEW_PAD = pad("upper(coalesce(LeakMaterialType, ''))")
OLD = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(upper(value), '{w}')" for w in ws) + f" THEN '{f}'" for f, ws in ROW_TERMS.items()) + " WHEN trim(value) = '' THEN 'UNKNOWN' ELSE 'OTHER' END"
IMPACT = f"""vals AS (SELECT LeakMaterialType AS value, count(*) AS n FROM supp WHERE LeakMaterialType IS NOT NULL GROUP BY 1), {decoded('vd', 'vals', 'value')},
impact AS (SELECT value, n, {OLD} AS family_before, rfam AS family_after FROM vd WHERE {OLD} <> rfam)"""
AUDIT = f"""rel AS ({RELOCATED}),
aud AS (SELECT rel.*, en.ASSETTYPE_DECODED AS PipeCache_ASSETTYPE_DECODED FROM rel LEFT JOIN en ON lower(rel.LinkedLayer) = en.layer AND rel.MatchedPipeOID = en.pipe_oid)"""
NORM = "CASE WHEN upper(trim(coalesce({0}, ''))) IN ('NAN', 'NONE') THEN '' ELSE upper(trim(coalesce({0}, ''))) END"
SAME = f"({NORM.format('MatchMaterial')} = {NORM.format('PipeCache_ASSETTYPE_DECODED')})"


def clip(a: str, b: str, lo: float, hi: float) -> tuple[str, str]:
    d = f"({b} - {a})"
    return f"CASE WHEN {d} = 0 THEN CASE WHEN {a} BETWEEN {lo} AND {hi} THEN 0 ELSE 2 END WHEN {d} > 0 THEN ({lo} - {a}) / {d} ELSE ({hi} - {a}) / {d} END", f"CASE WHEN {d} = 0 THEN 1 WHEN {d} > 0 THEN ({hi} - {a}) / {d} ELSE ({lo} - {a}) / {d} END"


WEST, SOUTH, EAST, NORTH = BOX
(X0, X1), (Y0, Y1) = clip("ax", "bx", WEST, EAST), clip("ay", "b_y", SOUTH, NORTH)
CONE = conic_constants()
E2 = FLATTENING * (2 - FLATTENING)
E1 = (1 - (1 - E2) ** 0.5) / (1 + (1 - E2) ** 0.5)
M0 = 1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256
WIDE = "wide AS (SELECT *, CAST(substr(LeakNumber, 4) AS BIGINT) AS n FROM supp)"
UNTIL = "(SELECT min(modified) + (max(modified) - min(modified)) * {} // 10 FROM ev)"
COPY = "c AS (SELECT * FROM ev WHERE modified <= " + UNTIL.format(9) + ")"
MARK = "mk AS (SELECT (max(modified) // 1000) * 1000 AS mark FROM c)"
EVENTS = "ev AS (SELECT *, epoch_us(ts) // 1000 AS modified FROM events)"
PROFILE = [("ASSETGROUP", "assetgroup"), ("ASSETTYPE", "assettype"), ("ASSETTYPE_DECODED", "ASSETTYPE_DECODED"), ("PipeMaterialFamily", "PipeMaterialFamily"), ("GradeMaterial", "CAST(NULL AS VARCHAR)")]
COLOR = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COLORS.items())



def degrees(x: str, y: str) -> str:
    """'lon,lat' of native feet, to seven decimals."""
    px, py = f"({x}) / {SEMI_MAJOR_FT!r}", f"({CONE['rho0']!r} - ({y}) / {SEMI_MAJOR_FT!r})"
    mu = f"(({CONE['g']!r} - sqrt({px}*{px} + {py}*{py})) / {M0!r})"
    lat = f"{mu} + {3 * E1 / 2 - 27 * E1**3 / 32!r}*sin(2*{mu}) + {21 * E1**2 / 16 - 55 * E1**4 / 32!r}*sin(4*{mu}) + {151 * E1**3 / 96!r}*sin(6*{mu}) + {1097 * E1**4 / 512!r}*sin(8*{mu})"
    return f"(round({CENTRAL_LON} + degrees(atan2({px}, {py}) / {CONE['n']!r}), 7) || ',' || round(degrees({lat}), 7))"


def feature(properties: str, kind: str, coordinates: str) -> str:
    return f"""'{{"type":"Feature","properties":{{' || {properties} || '}},"geometry":{{"type":"{kind}","coordinates":' || {coordinates} || '}}}}'"""


def props(**columns: str) -> str:
    """Text properties are marked by a leading quote."""
    return " || ',' || ".join(f"""'"{k}":"' || {e[1:]} || '"'""" if e.startswith('"') else f"""'"{k}":' || {e}""" for k, e in columns.items())


SHARP = "sqrt((dx*dx + dy*dy) / 2) > 120"  # the middle vertex is that far from the line between the ends
POINT = f"'[' || {degrees('x', 'y')} || ']'"


def meets_box(ax: str, ay: str, bx: str, b_y: str) -> str:
    (x0, x1), (y0, y1) = clip(ax, bx, WEST, EAST), clip(ay, b_y, SOUTH, NORTH)
    return f"greatest(0, {x0}, {y0}) <= least(1, {x1}, {y1})"


DATED = """dated AS (SELECT pipe_oid, o_orderdate AS i, assettype, x1, y1, dx, dy FROM pipes JOIN orders ON o_orderkey = pipe_oid // 1000000000 WHERE o_orderdate >= TIMESTAMP '1996-01-01')"""
REPORTED = [("LinkedLayer", "LinkedLayer"), ("MatchMaterial", "MatchMaterial"), ("MatchDiameter", "MatchDiameter"), ("MatchPressure", "MatchPressure"), ("SearchRadiusFt", "SearchRadiusFt")]
VIEWED = f"""v AS (SELECT pipe_oid, layer, x1, y1, dx, dy FROM pipes WHERE {meets_box('x1', 'y1', '(x1+dx)', '(y1+dy)')} OR {meets_box('(x1+dx)', '(y1+dy)', '(x1+dx+dy)', '(y1+dy-dx)')})"""

ORACLE = {
    "clean_keys": with_(BASE, WIDE) + f"SELECT CAST(n * 1000003 AS VARCHAR) AS wide_key, CAST(n * 1000003 AS VARCHAR) AS wide_view, CAST(n * 1000003 AS VARCHAR) AS wide_code, CASE WHEN n % 5 = 0 THEN '' ELSE (n * 4096) || '.5' END AS holed, LeakNumber, ordinal, {clean('LeakMaterialType')} AS cleaned, {key('LeakNumber')} AS join_key, {view_key('LeakNumber')} AS view_key, nullif(trim(Pressure), '') AS code FROM wide",
    "parse_numbers": with_(BASE, WIDE) + f"SELECT CAST(n * 1000003 AS DOUBLE) AS wide, CASE WHEN n % 5 > 0 THEN CAST(n * 4096 AS DOUBLE) + 0.5::DOUBLE END AS holed, LeakNumber, ordinal, {number('Diameter')} AS diameter, {number('LeakMaterialType')} AS in_material FROM wide",
    "decode_material": FAMILIES + counts("lbl").replace("AS family", "AS label"),
    "family_match": FAMILIES + counts("fam"),
    "family_row": FAMILIES + counts("rfam"),
    "family_viewer": with_(BASE) + f"SELECT LeakMaterialType, count(*) AS n, any_value(CASE WHEN trim({VIEW_PAD}) = '' THEN 'UNKNOWN' ELSE {terms(VIEW_PAD, VIEWER_TERMS, chr(39) + 'OTHER' + chr(39))} END) AS family FROM supp GROUP BY LeakMaterialType",
    "route_layers": with_(BASE)
    + f"""SELECT FacilityType, layer, count(*) AS n, CASE layer WHEN 'distribution' THEN '#0066cc' ELSE '#00a651' END AS color FROM (SELECT FacilityType, unnest(CASE WHEN contains({upper('FacilityType')}, 'SERVICE') THEN ['service']
      WHEN contains({upper('FacilityType')}, 'MAIN') OR contains({upper('FacilityType')}, 'DISTRIBUTION') THEN ['distribution'] ELSE ['distribution', 'service'] END) AS layer FROM supp) GROUP BY FacilityType, layer""",
    "search_ring": with_(BASE, matched()) + f"SELECT {RING} AS ring, count(*) AS n FROM m GROUP BY 1",
    "supplement_leaks": with_(BASE, GATED) + "SELECT leak_oid, leak_key, leak_diameter, leak_material, leak_pressure, facility, gate FROM gated",
    "supplemental_last": with_(BASE, SUPP_LAST) + "SELECT leak_key, leak_diameter, leak_material FROM s",
    "leak_gate_counts": with_(BASE, GATED) + "SELECT gate, count(*) AS n FROM gated GROUP BY gate",
    "prepare_pipes_counts": with_(BASE) + "SELECT layer, count(*) AS pipes, count(*) FILTER (assettype IS NULL) AS missing_material, count(*) FILTER (nominaldiameter IS NULL) AS missing_diameter FROM pipes GROUP BY layer",
    "enrich_pipes": with_(BASE, ENRICHED) + "SELECT pipe_oid, ASSETGROUP_DECODED, ASSETTYPE_DECODED, ASSETTYPE_DOMAIN, PipeMaterialFamily, CAST(assettype AS BIGINT) AS PipeMaterialRaw, ASSETTYPE_DECODED AS material FROM en",
    "decode_counts": with_(BASE, ENRICHED) + "SELECT assetgroup AS ASSETGROUP, assettype AS ASSETTYPE, ASSETGROUP_DECODED, ASSETTYPE_DECODED, PipeMaterialFamily, count(*) AS n FROM en GROUP BY ALL",
    "preflight_profile": with_(BASE, ENRICHED)
    + " UNION ALL ".join(f"SELECT '{name}' AS column_name, count({e}) AS filled, count(*) AS of_rows, coalesce((SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT CAST({e} AS VARCHAR) AS v FROM en WHERE {e} IS NOT NULL ORDER BY v LIMIT 3)), '-') AS sample FROM en" for name, e in PROFILE),
    "family_collapse": with_(BASE, ENRICHED) + "SELECT count(DISTINCT PipeMaterialFamily) AS families, count(*) AS n, count(DISTINCT PipeMaterialFamily) = 1 AND count(*) > 1 AS collapsed FROM en",
    "relocated_leaks": with_(BASE, matched()) + RELOCATED,
    "relocated_leaks_strict": with_(BASE, matched("up", "up", True)) + RELOCATED,
    "guide_lines": with_(BASE, matched()) + "SELECT m.leak_oid AS LeakOID, t.leak_key AS LeakKey, m.layer AS LinkedLayer, m.dist AS DistanceFt, m.pipe_oid AS MatchedPipeOID, t.x AS x0, t.y AS y0, m.nx AS x1, m.ny AS y1 FROM m JOIN tasks t ON m.leak_oid = t.leak_oid",
    "relocation_audit": with_(BASE, matched())
    + f"""SELECT t.leak_oid AS LeakOID, t.leak_key AS LeakKey, t.leak_material AS LeakMaterial, t.leak_diameter AS LeakDiameter, t.leak_pressure AS LeakPressure, t.facility AS FacilityType,
      coalesce(m.layer, array_to_string(t.allowed, ',')) AS LinkedLayer, m.pipe_oid AS MatchedPipeOID, coalesce(m.material, '') AS PipeMaterial, m.nominaldiameter AS PipeDiameter, coalesce(m.operatingpressure, '') AS PipePressure,
      CASE WHEN m.pipe_oid IS NOT NULL THEN {RING} END AS SearchRadiusFt, m.dist AS DistanceFt, CASE WHEN m.pipe_oid IS NULL THEN 'NoMatch' ELSE 'Matched' END AS MatchStatus,
      CASE WHEN m.pipe_oid IS NULL THEN 'no agreeing pipe within the search radius' ELSE '' END AS NoMatchReason, t.x AS OrigX, t.y AS OrigY, m.nx AS NewX, m.ny AS NewY FROM tasks t LEFT JOIN m ON m.leak_oid = t.leak_oid""",
    "run_counters": with_(BASE, matched())
    + """SELECT 'leaks_read' AS name, count(*) AS n FROM gated UNION ALL SELECT 'unmatched_missing_supplemental', count(*) FROM gated WHERE gate = 'missing_supplemental' UNION ALL SELECT 'unmatched_missing_match_attributes', count(*) FROM gated WHERE gate = 'missing_match_attributes'
      UNION ALL SELECT 'matched', count(*) FROM m UNION ALL SELECT 'unmatched', (SELECT count(*) FROM tasks) - (SELECT count(*) FROM m)""",
    "audit_agreement": with_(BASE, matched(), ENRICHED, AUDIT) + f"SELECT LinkedLayer, count(*) AS n, count(*) FILTER ({SAME}) AS equals_decoded, count(*) FILTER ({SAME}) AS equals_material, count(*) FILTER (regexp_full_match(MatchMaterial, '[A-Za-z0-9]{{1,3}}')) AS looks_like_old_code FROM aud GROUP BY LinkedLayer",
    "audit_disagreements": with_(BASE, matched(), ENRICHED, AUDIT) + f"SELECT OrigLeakOID, LinkedLayer, MatchedPipeOID, MatchMaterial, PipeCache_ASSETTYPE_DECODED FROM aud WHERE NOT {SAME}",
    "distance_describe": with_(BASE, matched())
    + "SELECT count(*) AS n, round(avg(dist), 3) AS mean, round(stddev_samp(dist), 3) AS std, round(min(dist), 3) AS low, round(max(dist), 3) AS high, "
    + ", ".join(f"round(quantile_cont(dist, {q}), 3) AS {n}" for q, n in ((0.5, "p50"), (0.75, "p75"), (0.9, "p90"), (0.95, "p95"), (0.99, "p99")))
    + " FROM m",
    "value_counts": with_(BASE, ENRICHED) + "SELECT ASSETTYPE_DECODED AS value, count(*) AS n FROM en GROUP BY 1 ORDER BY n DESC, value NULLS FIRST LIMIT 20",
    "family_impact": with_(BASE, IMPACT) + "SELECT * FROM impact",
    "affected_rows": with_(BASE, IMPACT) + "SELECT LeakNumber, ordinal, LeakMaterialType FROM supp WHERE LeakMaterialType IN (SELECT value FROM impact)",
    "impact_share": with_(BASE, IMPACT) + "SELECT n, changed_values, changed_rows, round(100.0 * changed_rows / greatest(n, 1), 2) AS percent FROM (SELECT (SELECT count(*) FROM supp) AS n, count(*) AS changed_values, CAST(coalesce(sum(n), 0) AS BIGINT) AS changed_rows FROM impact)",
    "wanted_rows": with_(BASE) + "SELECT pipe_oid AS OBJECTID, nominaldiameter FROM pipes WHERE layer <> 'service' AND pipe_oid IN (SELECT pipe_oid FROM pipes WHERE nominaldiameter >= 2)",
    "relocated_sample": with_(BASE, matched(), f"rel AS ({RELOCATED})") + "SELECT OrigLeakOID, LinkedLayer, MatchedPipeOID, MatchMaterial FROM rel ORDER BY OrigLeakOID LIMIT 25",
    "layer_bounds": with_(BASE) + "SELECT min(x) AS west, min(y) AS south, max(x) AS east, max(y) AS north, (min(x) + max(x)) / 2 AS center_x, (min(y) + max(y)) / 2 AS center_y FROM (SELECT ax AS x, ay AS y FROM segments UNION ALL SELECT bx, b_y FROM segments UNION ALL SELECT x, y FROM leaks)",
    "viewport_points": with_(BASE, f"v AS (SELECT leak_oid, x, y FROM leaks WHERE x BETWEEN {WEST} AND {EAST} AND y BETWEEN {SOUTH} AND {NORTH})") + "SELECT *, (SELECT count(*) FROM v) AS total_in_view, (SELECT count(*) FROM v) > 25000 AS truncated FROM v ORDER BY leak_oid LIMIT 25000",
    "viewport_lines": with_(BASE) + f"SELECT pipe_oid, count(*) AS segments_in_view FROM segments WHERE greatest(0, {X0}, {Y0}) <= least(1, {X1}, {Y1}) GROUP BY pipe_oid",
    "table_page": """WITH v AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE contains(CAST(c_custkey AS VARCHAR), '7') OR contains(lower(c_name), '7') OR contains(CAST(c_nationkey AS VARCHAR), '7') OR contains(lower(c_mktsegment), '7'))
SELECT *, (SELECT count(*) FROM v) AS total_rows FROM v ORDER BY c_custkey DESC LIMIT 500""",
    "reproject_points": with_(
        BASE,
        f"q AS (SELECT leak_oid, x / {SEMI_MAJOR_FT!r} AS px, {CONE['rho0']!r} - y / {SEMI_MAJOR_FT!r} AS py FROM leaks)",
        f"r AS (SELECT leak_oid, px, py, ({CONE['g']!r} - sqrt(px*px + py*py)) / {M0!r} AS mu FROM q)",
    )
    + f"""SELECT leak_oid, CAST(round(({CENTRAL_LON} + degrees(atan2(px, py) / {CONE['n']!r})) * 1e7) AS BIGINT) AS lon_e7,
      CAST(round(degrees(mu + {3 * E1 / 2 - 27 * E1**3 / 32!r}*sin(2*mu) + {21 * E1**2 / 16 - 55 * E1**4 / 32!r}*sin(4*mu) + {151 * E1**3 / 96!r}*sin(6*mu) + {1097 * E1**4 / 512!r}*sin(8*mu)) * 1e7) AS BIGINT) AS lat_e7, true AS round_trip FROM r""",
    "line_centroids": with_(BASE, "one AS (SELECT DISTINCT pipe_oid, x1, y1, dx, dy FROM pipes)") + "SELECT pipe_oid, round(CASE WHEN dx = 0 AND dy = 0 THEN x1 ELSE (x1 + dx/2 + x1 + dx + dy/2) / 2 END, 3) AS x, round(CASE WHEN dx = 0 AND dy = 0 THEN y1 ELSE (y1 + dy/2 + y1 + dy - dx/2) / 2 END, 3) AS y FROM one",
    "wkt_export": with_(BASE) + "SELECT pipe_oid, 'LINESTRING (' || CAST(x1 AS BIGINT) || ' ' || CAST(y1 AS BIGINT) || ', ' || CAST(x1 + dx AS BIGINT) || ' ' || CAST(y1 + dy AS BIGINT) || ')' AS wkt FROM pipes",
    "upsert_layer": with_(EVENTS, COPY, f"ch AS (SELECT * FROM ev WHERE modified > {UNTIL.format(5)})")
    + "SELECT event_id, 'old' AS event_type, CAST(NULL AS BIGINT) AS user_id FROM c WHERE event_id NOT IN (SELECT event_id FROM ch) UNION ALL SELECT event_id, event_type, user_id FROM ch",
    "delta_rows": with_(EVENTS, COPY, MARK) + "SELECT event_id, event_type FROM ev WHERE event_type <> 'error' AND modified > (SELECT mark FROM mk)",
    "refresh_watermark": with_(EVENTS) + "SELECT event_type, max(modified) AS ms, strftime(make_timestamp((max(modified) // 1000) * 1000000), '%Y-%m-%d %H:%M:%S') AS watermark FROM ev GROUP BY event_type",
    "refresh_watermark_all": with_(EVENTS) + "SELECT max(modified) AS ms, strftime(make_timestamp((max(modified) // 1000) * 1000000), '%Y-%m-%d %H:%M:%S') AS watermark FROM ev",
    "refresh_decision": with_(EVENTS, COPY, "k AS (SELECT * FROM c WHERE event_type <> 'error')", "mk AS (SELECT (max(modified) // 1000) * 1000 AS mark FROM k)", "dl AS (SELECT * FROM ev WHERE modified > (SELECT mark FROM mk))", "mg AS (SELECT event_id FROM k WHERE event_id NOT IN (SELECT event_id FROM dl) UNION ALL SELECT event_id FROM dl)")
    + "SELECT event_type, count(*) AS n, CASE WHEN (SELECT count(*) FROM mg) = (SELECT count(*) FROM ev) THEN 'upsert' ELSE 'reload' END AS step FROM ev GROUP BY event_type",
    "refresh_merged": with_(EVENTS, "c AS (SELECT * FROM ev WHERE modified <= (SELECT min(modified) + (max(modified) - min(modified)) * 9 // 10 FROM ev))", "mk AS (SELECT (max(modified) // 1000) * 1000 AS mark FROM c)")
    + "SELECT event_id, CASE WHEN modified > (SELECT mark FROM mk) THEN event_type ELSE 'old' END AS event_type, user_id, 'upsert' AS step FROM ev",
    "watermark_literals": with_(EVENTS) + "SELECT event_id, (event_id % 7 - 3) * modified AS ms, CASE WHEN (event_id % 7 - 3) * modified BETWEEN 1 AND 32503680000000 THEN strftime(make_timestamp(((event_id % 7 - 3) * modified // 1000) * 1000000), '%Y-%m-%d %H:%M:%S') ELSE '1970-01-01 00:00:00' END AS mark, ms AS wide_ms, mark AS wide_mark FROM ev",
    "date_export": """WITH o AS (SELECT o_orderkey AS OBJECTID, o_orderdate AS i, CASE WHEN o_custkey % 3 > 0 THEN o_orderdate - INTERVAL 400 DAY END AS c FROM orders)
SELECT OBJECTID, strftime(i, '%Y-%m-%dT%H:%M:%S') AS installed, epoch_us(c) // 1000 AS CREATIONDATE FROM o WHERE i >= TIMESTAMP '1996-01-01' OR c >= TIMESTAMP '1996-01-01'""",
    "feature_pages": with_(BASE) + "SELECT pipe_oid, layer, CAST(1 AS BIGINT) AS paths, x1 AS x, y1 + dy AS y FROM pipes WHERE assettype IS NOT NULL",
    "display_leaks": with_(BASE, f"k AS (SELECT *, {view_key('LeakNumber')} AS k FROM supp)", "o AS (SELECT * FROM k WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY ordinal, Diameter, LeakMaterialType, FacilityType, Pressure) = 1)")
    + f"SELECT leak_oid, {view_key('leak_key_raw')} AS JoinLeakKey, LeakMaterialType AS SuppLeakMaterialType, Diameter AS SuppDiameter, FacilityType AS SuppFacilityType FROM leaks LEFT JOIN o ON {view_key('leak_key_raw')} = o.k",
    "display_pipes": with_(BASE, ENRICHED) + f"SELECT pipe_oid, CAST(assettype AS VARCHAR) AS PipeMaterialRaw, ASSETTYPE_DECODED AS PipeMaterialDomain, coalesce(PipeMaterialFamily, 'UNKNOWN') AS PipeMaterialFamily, nominaldiameter AS PipeDiameter, CASE coalesce(PipeMaterialFamily, 'UNKNOWN') {COLOR} END AS PipeMaterialColor FROM en",
    "filtered_count": with_(BASE) + "SELECT count(*) AS n FROM leaks WHERE jurisdiction = 'MA'",
    "distinct_ids": with_(BASE) + "SELECT DISTINCT pipe_oid FROM pipes",
    "stacked_layers": with_(BASE) + "SELECT pipe_oid, layer, CASE WHEN layer = 'distribution' THEN nominaldiameter END AS nominaldiameter FROM pipes",
    "snapshot_roundtrip": with_(BASE) + "SELECT pipe_oid, nominaldiameter, x1, dy FROM pipes WHERE layer = 'service'",
    "csv_roundtrip": with_(BASE) + "SELECT nullif(Diameter, '') AS Diameter, nullif(FacilityType, '') AS FacilityType, nullif(Pressure, '') AS Pressure, CAST(ordinal AS VARCHAR) AS row_no, count(*) AS n FROM supp GROUP BY ALL",
    "duplicate_ids_last": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1",
    "layer_sample": with_(BASE) + "SELECT * FROM leaks ORDER BY md5(CAST(leak_oid AS VARCHAR) || ':17'), leak_oid LIMIT 3500",
    "simplify_lines": with_(BASE) + f"SELECT pipe_oid, CAST(CASE WHEN {SHARP} THEN 3 ELSE 2 END AS BIGINT) AS vertices FROM pipes",
    "geojson_features": with_(BASE) + f"SELECT {feature(props(leak_oid='leak_oid'), 'Point', POINT)} AS feature FROM leaks",
    "paged_layer": with_(BASE) + "SELECT pipe_oid, layer, CAST(1 AS BIGINT) AS paths, x1 AS x, y1 + dy AS y FROM pipes WHERE assettype IS NOT NULL",
    "job_relocated_leaks": with_(BASE, matched(), f"rel AS ({RELOCATED})") + "SELECT * EXCLUDE (x, y), '{P-' || MatchedPipeOID || '}' AS MatchedPipeGID, 'POINT (' || x || ' ' || y || ')' AS geometry FROM rel",
    "job_offset_lines": with_(BASE, matched()) + "SELECT m.leak_oid AS LeakOID, t.leak_key AS LeakKey, m.layer AS LinkedLayer, m.dist AS DistanceFt, m.pipe_oid AS MatchedPipeOID, 'LINESTRING (' || t.x || ' ' || t.y || ', ' || m.nx || ' ' || m.ny || ')' AS geometry FROM m JOIN tasks t ON m.leak_oid = t.leak_oid",
    "enrich_job": with_(BASE, ENRICHED) + "SELECT ASSETTYPE_DECODED, count(*) AS n, unnest(['counted', 'skipped', 'enriched']) AS step FROM en GROUP BY ASSETTYPE_DECODED",
    "report_counts": with_(BASE, matched(), f"rel AS ({RELOCATED})") + " UNION ALL ".join(f"SELECT '{name}' AS column_name, CAST({e} AS VARCHAR) AS value, count(*) AS n FROM rel GROUP BY 2" for name, e in REPORTED),
    "report_rows": with_(BASE, matched(), f"rel AS ({RELOCATED})") + "SELECT OrigLeakOID, LinkedLayer, MatchedPipeOID, MatchMaterial, 'POINT (' || round(x, 3) || ' ' || round(y, 3) || ')' AS WKT FROM rel ORDER BY OrigLeakOID LIMIT 250",
    "viewport_answer": with_(BASE, VIEWED)
    + f"""SELECT pipe_oid, {feature(props(pipe_oid='pipe_oid', layer='"layer'), 'LineString', f"'[[' || {degrees('x1', 'y1')} || CASE WHEN {SHARP} THEN '],[' || {degrees('x1+dx', 'y1+dy')} ELSE '' END || '],[' || {degrees('x1+dx+dy', 'y1+dy-dx')} || ']]'")} AS feature,
      (SELECT count(*) FROM v) AS total_in_view, (SELECT count(*) FROM v) > 25000 AS truncated FROM v ORDER BY pipe_oid, x1, y1, dx, dy LIMIT 25000""",
    "context_export": with_(BASE, "dr AS (SELECT * FROM leaks ORDER BY md5(CAST(leak_oid AS VARCHAR) || ':17'), leak_oid LIMIT 3500)", f"ll AS (SELECT leak_oid, {degrees('x', 'y')} AS p FROM dr)")
    + f"""SELECT leak_oid, {feature(props(leak_oid='leak_oid'), 'Point', "'[' || p || ']'")} AS feature, {", ".join(f"(SELECT {f}(CAST(split_part(p, ',', {i}) AS DOUBLE)) FROM ll) AS {n}" for f, i, n in (("min", 1, "west"), ("min", 2, "south"), ("max", 1, "east"), ("max", 2, "north")))} FROM ll""",
    "viewer_export": with_(BASE, matched(), f"rel AS ({RELOCATED})")
    + f"""SELECT 'relocated_leaks' AS layer, {feature(props(OrigLeakOID='OrigLeakOID', LinkedLayer='"LinkedLayer', MatchedPipeOID='MatchedPipeOID', SearchRadiusFt='SearchRadiusFt'), 'Point', POINT)} AS feature FROM rel
      UNION ALL SELECT 'relocated_leak_offset_lines', {feature(props(LeakOID='m.leak_oid', LinkedLayer='"m.layer', MatchedPipeOID='m.pipe_oid'), 'LineString', f"'[[' || {degrees('t.x', 't.y')} || '],[' || {degrees('m.nx', 'm.ny')} || ']]'")} FROM m JOIN tasks t ON m.leak_oid = t.leak_oid""",
    "export_job": with_(BASE, DATED, "d AS (SELECT *, strftime(i, '%Y-%m-%dT%H:%M:%S') AS installed FROM dated)")
    + f"""SELECT pipe_oid, installed, 'csv' AS part FROM d UNION ALL SELECT pipe_oid, installed, 'geojson [[' || {degrees('x1', 'y1')} || '],[' || {degrees('x1+dx', 'y1+dy')} || ']]' FROM d WHERE assettype IS NOT NULL""",
    "export_count": with_(BASE, DATED) + "SELECT count(*) AS n FROM dated",
}
ORACLE["job_audit"] = with_(BASE, matched(), f"au AS ({ORACLE['relocation_audit'].split(matched(), 1)[1]})") + f"SELECT *, '{{L-' || LeakOID || '}}' AS LeakGlobalID, '{{P-' || MatchedPipeOID || '}}' AS MatchedPipeGID, '{RUN_UTC}' AS RunUTC, 'POINT (' || OrigX || ' ' || OrigY || ')' AS geometry FROM au"
ORACLE["refresh_job"] = ORACLE["refresh_merged"]
ORACLE["stream_latest"] = with_(EVENTS) + "SELECT user_id, event_id, event_type, modified FROM ev QUALIFY user_id IS NULL OR row_number() OVER (PARTITION BY user_id ORDER BY modified DESC, event_id DESC) = 1"
ORACLE["date_variants"] = """WITH n AS (SELECT count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT layer, chosen, CASE layer WHEN 'none' THEN 0 ELSE n END AS n FROM n, (VALUES ('ms', 'milliseconds'), ('text', 'text'), ('s', 'seconds'), ('none', 'milliseconds')) v(layer, chosen)"""
ORACLE["date_export_text"] = "SELECT o_orderkey AS OBJECTID, strftime(o_orderdate, '%Y-%m-%d') AS installationdate, o_custkey AS c FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'"
ORACLE["csv_file_order"] = "SELECT o_custkey AS custkey, o_orderkey % 7 AS file, o_orderkey AS line FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 7 DESC, o_orderkey DESC) = 1"
ORACLE["clustered_view"] = with_(BASE, ENRICHED, VIEWED.replace("SELECT pipe_oid, layer, x1, y1, dx, dy FROM pipes WHERE ", "SELECT DISTINCT pipe_oid, coalesce(PipeMaterialFamily, 'UNKNOWN') AS fam, x1, y1, dx, dy FROM en WHERE assettype IS NOT NULL AND (") + ")") + f"""SELECT pipe_oid, {feature(props(pipe_oid='pipe_oid', PipeMaterialFamily='"fam', PipeMaterialColor=f'"CASE fam {COLOR} END'), 'LineString', f"'[[' || {degrees('x1', 'y1')} || CASE WHEN {SHARP} THEN '],[' || {degrees('x1+dx', 'y1+dy')} ELSE '' END || '],[' || {degrees('x1+dx+dy', 'y1+dy-dx')} || ']]'")} AS feature,
      (SELECT count(*) FROM v) AS total_in_view, (SELECT count(*) FROM v) > 400 AS truncated FROM v ORDER BY pipe_oid LIMIT 400"""
ORACLE["paged_source"] = with_(BASE, DATED) + "SELECT pipe_oid, epoch_us(i) // 1000 AS installationdate, x1 AS x, y1 + dy AS y FROM dated WHERE assettype IS NOT NULL"
ORACLE["two_systems"] = with_(BASE) + "SELECT 'leaks' AS layer, leak_oid AS id, x, y FROM leaks UNION ALL SELECT layer, pipe_oid, x1, y1 FROM pipes"
