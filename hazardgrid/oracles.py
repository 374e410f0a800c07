"""The same results in plain SQL, by brute force where the engine is clever.

Thresholds are counted (how many are not above the value), gaps and zones are worked out on dense
grids, cells are tested against every edge of a zone.
"""

from __future__ import annotations

from math import inf

from hazardgrid.catalog import PROTECTION_FACTOR, QUANTILE_BINS, RP_WEIGHTS, SETTINGS, ascending, threshold_rows, thresholds
from hazardgrid.fixtures import N_LAT, with_views
from hazardgrid.schema import HAZARD_COLUMNS, HAZARDS, TIMES

ORACLES: dict[str, str] = {}

N_LON = "(SELECT GREATEST(COUNT(*) // 20, 1) FROM part)"


def _num(x: float) -> str:
    if x in (inf, -inf):
        return f"CAST('{'-' if x < 0 else ''}Infinity' AS DOUBLE)"
    return f"CAST({x!r} AS DOUBLE)"


def _array(values) -> str:
    return "[" + ", ".join(_num(float(v)) for v in values) + "]"


def digitize(v: str, hazard: str, scale: str, threshold_type: str | None = None) -> str:
    """Score by counting the thresholds that do not exceed the value."""
    t, s = ascending(*thresholds(hazard, scale, threshold_type=threshold_type))
    count = f"len(list_filter({_array(t)}, lambda x: x <= ({v})))"
    return (
        f"CASE WHEN ({v}) IS NULL THEN NULL WHEN ({v}) = {_num(inf)} THEN {_num(float(s[-1]))} "
        f"WHEN ({v}) = {_num(-inf)} THEN {_num(float(s[0]))} "
        f"ELSE ({_array(s)})[GREATEST(1, LEAST({count}, {len(s)}))] END"
    )


def by_hazard(v: str, scale: str, hazards=HAZARDS) -> str:
    arms = " ".join(
        f"WHEN '{h}' THEN {digitize(v, h, scale, 'thresholds_final' if h == 'LS' else None)}" for h in hazards
    )
    return f"CASE hazard {arms} END"


def minmax(v: str, lo: str = "lo", hi: str = "hi") -> str:
    ratio = f"(({v}) - {lo}) / ({hi} - {lo}) * 100"
    return (
        f"CASE WHEN {lo} IS NULL OR {hi} IS NULL OR {lo} = {hi} THEN CAST(0 AS DOUBLE) "
        f"WHEN ({v}) IS NULL OR isnan({ratio}) THEN NULL "
        f"ELSE LEAST(GREATEST({ratio}, 0), 100) END"
    )


def oracle(name: str, body: str, *views: str) -> None:
    ORACLES[name] = with_views(body, *views)


def _with(views: tuple[str, ...], ctes: list[str], body: str) -> str:
    head = with_views("", *views).rstrip()
    return f"{head}{',' if head else 'WITH'} {', '.join(ctes)}\n{body}"


def add(name: str, views: tuple[str, ...], ctes: list[str], body: str) -> None:
    ORACLES[name] = _with(views, ctes, body)


# --- sources, sinks, filters ---------------------------------------------------------------------

oracle("read_cells", """SELECT hazard, scenario, time, model, statistic, metric, lat_idx, lon_idx, lat, lon, value, rp
FROM cells_fx WHERE hazard = 'HS' AND scenario IN ('RCP45', 'RCP85')""", "cells_fx")
oracle("read_zones_country", "SELECT * FROM zones_fx WHERE GID_0 = 'NATION_7'", "zones_fx")
oracle("list_countries", "SELECT DISTINCT GID_0 FROM zones_fx WHERE GID_0 <> 'NATION_3'", "zones_fx")
oracle("zones_partitioned", "SELECT * FROM zones_fx", "zones_fx")
oracle("coast_clip", "SELECT * FROM coast_fx WHERE lat >= 7 AND lat <= 31.2 AND lon >= 2.2 AND lon <= 41.7", "coast_fx")


def _threshold_use() -> str:
    """Bin numbers by counting, per hazard, threshold kind and scale."""
    tables: dict[tuple[str, str, str], list[tuple[float, int]]] = {}
    for hazard, _, kind, scale, _, lo, _, score in threshold_rows():
        tables.setdefault((hazard, kind, scale), []).append((lo, score))
    parts = []
    for (hazard, kind, scale), rows in tables.items():
        starts, scores = [r[0] for r in rows], [r[1] for r in rows]
        place = f"len(list_filter({_array(starts)}, lambda x: x <= v))"
        parts.append(
            f"SELECT hazard, '{kind}' AS threshold_type, '{scale}' AS scale, CAST({place} - 1 AS INT) AS bin, "
            f"CAST(({_array(scores)})[{place}] AS INT) AS score FROM src WHERE hazard = '{hazard}'"
        )
    return " UNION ALL ".join(parts)


add("threshold_table", ("cells_fx",), [
    "src AS (SELECT hazard, COALESCE(rp, value) AS v FROM cells_fx WHERE COALESCE(rp, value) IS NOT NULL)",
    f"u AS ({_threshold_use()})",
], "SELECT hazard, threshold_type, scale, bin, score, COUNT(*) AS n FROM u GROUP BY ALL")

oracle("read_hazard_stats", "SELECT * FROM stats_fx WHERE hazard <> 'TS'", "stats_fx")
oracle("write_hazard_stats", """SELECT * REPLACE (CASE WHEN hazard IN ('HS', 'CS') THEN score_mean + 1 ELSE score_mean END AS score_mean)
FROM stats_fx""", "stats_fx")
oracle("scored_upsert", f"""SELECT hazard, '5' AS scoring, scenario, time, lat_idx, lon_idx, {digitize('value', 'HS', '5')} AS score FROM hazard_grid_fx
UNION ALL SELECT hazard, '10', scenario, time, lat_idx, lon_idx, ROUND(value / 5, 4) FROM hazard_grid_fx
UNION ALL SELECT hazard, '100', scenario, time, lat_idx, lon_idx, ROUND(value * 2, 4) FROM hazard_grid_fx""", "hazard_grid_fx")
oracle("stage_reuse", "SELECT scenario, time, lat_idx, lon_idx, value FROM grid_fx", "grid_fx")
oracle("metric_select", "SELECT * EXCLUDE (metric, lat, lon) FROM cells_fx WHERE metric = 'p5'", "cells_fx")
oracle("scale_factor", "SELECT hazard, l_orderkey, l_linenumber, value * 100 AS value FROM cells_fx", "cells_fx")
oracle("drop_singletons", "SELECT '5' AS scoring, scenario, time, model, lat_idx, lon_idx, value FROM cells_fx", "cells_fx")

_CELL_LABELS = "hazard, scenario, time, statistic, model, metric, lat_idx, lon_idx"
oracle("score_multi", " UNION ALL ".join(
    f"SELECT {_CELL_LABELS}, '{k}' AS scoring, {digitize('value', 'HS', k)} AS score FROM cells_fx" for k in ("5", "10")
), "cells_fx")
oracle("fill_missing", "SELECT hazard, l_orderkey, l_linenumber, COALESCE(value, 0) AS value FROM cells_fx", "cells_fx")
oracle("normalize_numeric", "SELECT hazard, l_orderkey, l_linenumber, value, rp FROM cells_fx", "cells_fx")
oracle("prefer_statistic", "SELECT * EXCLUDE (lat, lon) FROM cells_fx WHERE statistic = 'mean'", "cells_fx")
oracle("reference_slice", "SELECT * EXCLUDE (lat, lon) FROM cells_fx WHERE scenario = 'RCP45' AND time = 'Lt'", "cells_fx")
oracle("bbox_filter", """SELECT hazard, l_orderkey, l_linenumber, lat, lon FROM cells_fx
WHERE lat >= 3.6 AND lat <= 41.9 AND lon >= 2.7 AND lon <= 41.2""", "cells_fx")
oracle("split_scales", """SELECT hazard, gadm_id, scoring, scenario, time, CASE scoring WHEN '100' THEN 'hundred' ELSE 'threshold' END AS part
FROM stats_fx""", "stats_fx")
oracle("select_stats", "SELECT * FROM stats_fx WHERE scoring = '5' AND scenario = 'RCP45'", "stats_fx")
oracle("land_mask", """SELECT g.scenario, g.time, g.lat_idx, g.lon_idx, CASE WHEN c.mask > 0 THEN g.value END AS score
FROM grid_fx g LEFT JOIN coast_fx c ON g.lat_idx = c.lat_idx AND g.lon_idx = c.lon_idx""", "grid_fx", "coast_fx")
add("dedupe_coords", ("hazard_grid_fx",), [
    """d AS (SELECT hazard, scenario, time, lat_idx, lon_idx, FLOOR(lat_idx / 2) + CAST(0.5 AS DOUBLE) AS lat,
  FLOOR(lon_idx / 3) + CAST(0.5 AS DOUBLE) AS lon, value FROM hazard_grid_fx)""",
    """w AS (SELECT *, MIN(lat_idx) OVER (PARTITION BY hazard, lat) AS first_lat,
  MIN(lon_idx) OVER (PARTITION BY hazard, lon) AS first_lon FROM d)""",
], "SELECT hazard, scenario, time, lat_idx, lon_idx, lat, lon, value FROM w WHERE lat_idx = first_lat AND lon_idx = first_lon")

# --- zones ---------------------------------------------------------------------------------------

# Edges in the same grid units as the engine uses, and every cell near a zone.
_EDGES = """e AS (SELECT gadm_id, gid0, (x1 - 0.5) / 1.0 + 0.5 AS x1, (y1 - 0.5) / 1.0 + 0.5 AS y1,
  (x2 - 0.5) / 1.0 + 0.5 AS x2, (y2 - 0.5) / 1.0 + 0.5 AS y2 FROM edges_fx)"""
_NEAR = f"""bb AS (SELECT gadm_id, gid0, MIN(LEAST(x1, x2)) AS minx, MAX(GREATEST(x1, x2)) AS maxx,
  MIN(LEAST(y1, y2)) AS miny, MAX(GREATEST(y1, y2)) AS maxy FROM e GROUP BY 1, 2),
rr AS (SELECT *, UNNEST(range(GREATEST(0, FLOOR(miny)::BIGINT - 1), LEAST({N_LAT}, CEIL(maxy)::BIGINT + 1))) AS r FROM bb),
near AS (SELECT gadm_id, gid0, CAST(r AS INT) AS r,
  CAST(UNNEST(range(GREATEST(0, FLOOR(minx)::BIGINT - 1), LEAST({N_LON}, CEIL(maxx)::BIGINT + 1))) AS INT) AS c FROM rr)"""
_INSIDE = """inside AS (SELECT near.gadm_id, near.gid0, r, c,
  COUNT(CASE WHEN (y1 <= r + 0.5) <> (y2 <= r + 0.5)
    AND CASE WHEN y1 <= y2 THEN x1 + (r + 0.5 - y1) * ((x2 - x1) / (y2 - y1)) ELSE x2 + (r + 0.5 - y2) * ((x1 - x2) / (y1 - y2)) END <= c + 0.5
    THEN 1 END) % 2 = 1 AS within
  FROM near JOIN e USING (gadm_id) GROUP BY ALL)"""
_CENTER = "zc AS (SELECT gadm_id, gid0, r AS lat_idx, c AS lon_idx, CAST(1 AS DOUBLE) AS coverage FROM inside WHERE within)"

# The part of an edge inside a raster row: lower and upper end, as x and y.
_PIECES = """up AS (SELECT gadm_id, gid0, CASE WHEN y1 > y2 THEN -1 ELSE 1 END AS sgn,
  CASE WHEN y1 > y2 THEN x2 ELSE x1 END AS x1, LEAST(y1, y2) AS y1, CASE WHEN y1 > y2 THEN x1 ELSE x2 END AS x2, GREATEST(y1, y2) AS y2 FROM e),
pc AS (SELECT near.gadm_id, near.gid0, r, c, sgn, GREATEST(y1, r) AS ya, LEAST(y2, r + 1) AS yb,
  CASE WHEN y1 = y2 THEN x1 ELSE x1 + (GREATEST(y1, r) - y1) * ((x2 - x1) / (y2 - y1)) END AS xa,
  CASE WHEN y1 = y2 THEN x2 ELSE x1 + (LEAST(y2, r + 1) - y1) * ((x2 - x1) / (y2 - y1)) END AS xb
  FROM near JOIN up USING (gadm_id) WHERE r >= FLOOR(y1) AND r <= GREATEST(FLOOR(y1), CEIL(y2) - 1))"""
_TOUCHED = """tc AS (SELECT DISTINCT gadm_id, gid0, r, c FROM pc WHERE c >= FLOOR(LEAST(xa, xb)) AND c <= FLOOR(GREATEST(xa, xb))),
zc AS (SELECT gadm_id, gid0, r AS lat_idx, c AS lon_idx, CAST(1 AS DOUBLE) AS coverage
  FROM (SELECT gadm_id, gid0, r, c FROM tc UNION SELECT gadm_id, gid0, r, c FROM inside WHERE within))"""
# Integral of the clamped distance to the right cell edge, in closed form.
_COVER = """u AS (SELECT *, c + 1 - xa AS u0, c + 1 - xb AS u1 FROM pc WHERE yb > ya),
g AS (SELECT *, (POWER(GREATEST(u0, 0), 2) - POWER(GREATEST(u0 - 1, 0), 2)) / 2 AS g0,
  (POWER(GREATEST(u1, 0), 2) - POWER(GREATEST(u1 - 1, 0), 2)) / 2 AS g1 FROM u),
zc AS (SELECT gadm_id, gid0, r AS lat_idx, c AS lon_idx,
  ABS(SUM(sgn * (yb - ya) * CASE WHEN u0 = u1 THEN LEAST(GREATEST(u0, 0), 1) ELSE (g1 - g0) / (u1 - u0) END)) AS coverage
  FROM g GROUP BY 1, 2, 3, 4 HAVING coverage > 1e-9)"""

CENTER = [_EDGES, _NEAR, _INSIDE, _CENTER]
TOUCHED = [_EDGES, _NEAR, _INSIDE, _PIECES, _TOUCHED]
COVER = [_EDGES, _NEAR, _PIECES, _COVER]

add("zone_cells_center", ("edges_fx",), CENTER, "SELECT * FROM zc")
oracle("zones_to_edges", "SELECT gadm_id, gid0, part, ring, CAST(seq AS INT) AS seq, x1, y1, x2, y2 FROM edges_fx", "edges_fx")
# Even-odd on points between the quarters of a cell, on which all vertices lie: no signs, exact shares.
_QUARTERS = """pt AS (SELECT gadm_id, gid0, r, c, r + (q + 0.5) / 4 AS py, c + (p + 0.5) / 4 AS px
  FROM near CROSS JOIN range(4) a(q) CROSS JOIN range(4) b(p)),
ins AS (SELECT pt.gadm_id, pt.gid0, r, c, px, py,
  COUNT(CASE WHEN (y1 <= py) <> (y2 <= py) AND x1 + (py - y1) * (x2 - x1) / (y2 - y1) <= px THEN 1 END) % 2 AS odd
  FROM pt JOIN e USING (gadm_id) GROUP BY ALL)"""
add("zone_cells_winding", ("windings_fx",), [_EDGES.replace("edges_fx", "windings_fx"), _NEAR, _QUARTERS],
    "SELECT gadm_id, gid0, r AS lat_idx, c AS lon_idx, SUM(odd) / 16 AS coverage FROM ins GROUP BY ALL HAVING coverage > 0")
add("zone_cells_touched", ("edges_fx",), TOUCHED, "SELECT * FROM zc")
add("zone_runs", ("edges_fx",), TOUCHED, """SELECT gadm_id, lat_idx, COUNT(CASE WHEN before IS NULL OR before < lon_idx - 1 THEN 1 END) AS runs, COUNT(*) AS cells,
  MIN(lon_idx) AS first, MAX(lon_idx) AS last
FROM (SELECT *, LAG(lon_idx) OVER (PARTITION BY gadm_id, lat_idx ORDER BY lon_idx) AS before FROM zc) GROUP BY gadm_id, lat_idx""")
add("zone_cells_coverage", ("edges_fx",), COVER, "SELECT gadm_id, gid0, lat_idx, lon_idx, ROUND(coverage, 6) AS coverage FROM zc")
ORACLES["zone_cells_wkb"] = ORACLES["zone_cells_coverage"]

add("clip_to_zones", ("cells_fx", "edges_fx"), CENTER, """SELECT hazard, l_orderkey, l_linenumber, lat_idx, lon_idx FROM cells_fx, (
  SELECT MIN(lat_idx) AS r0, MAX(lat_idx) AS r1, MIN(lon_idx) AS c0, MAX(lon_idx) AS c1 FROM zc WHERE gid0 = 'NATION_7') b
WHERE lat_idx >= r0 AND lat_idx <= r1 AND lon_idx >= c0 AND lon_idx <= c1""")

# A box meets a polygon if a corner of one lies in the other or two of their edges cross.
add("zones_in_bbox", ("edges_fx",), [
    """sides AS (SELECT * FROM (VALUES (3.3, 20.2, 8.1, 20.2), (8.1, 20.2, 8.1, 26.4), (8.1, 26.4, 3.3, 26.4), (3.3, 26.4, 3.3, 20.2)) t(px, py, qx, qy))""",
    """x AS (SELECT gadm_id, gid0,
  BOOL_OR(x1 >= 3.3 AND x1 <= 8.1 AND y1 >= 20.2 AND y1 <= 26.4) AS vertex_in,
  COUNT(DISTINCT CASE WHEN (y1 <= 20.2) <> (y2 <= 20.2) AND x1 + (20.2 - y1) * (x2 - x1) / (y2 - y1) <= 3.3 THEN (ring, seq) END) % 2 = 1 AS corner_in,
  BOOL_OR(((qx - px) * (y1 - py) - (qy - py) * (x1 - px)) * ((qx - px) * (y2 - py) - (qy - py) * (x2 - px)) <= 0
    AND ((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)) * ((x2 - x1) * (qy - y1) - (y2 - y1) * (qx - x1)) <= 0) AS sides_cross
  FROM edges_fx CROSS JOIN sides GROUP BY 1, 2)""",
], "SELECT gadm_id, gid0 FROM x WHERE vertex_in OR corner_in OR sides_cross")

# --- joins ---------------------------------------------------------------------------------------

oracle("align_product", """SELECT scenario, time, g.lat_idx, g.lon_idx, value * protection AS product
FROM grid_fx g JOIN static_fx s ON g.lat_idx = s.lat_idx AND g.lon_idx = s.lon_idx""", "grid_fx", "static_fx")


def _nearest(axis: str) -> str:
    return f"""{axis}_map AS (SELECT {axis}, {axis}_idx, src FROM (SELECT t.{axis}, t.{axis}_idx, s.{axis} AS src,
  ROW_NUMBER() OVER (PARTITION BY t.{axis}_idx ORDER BY ABS(t.{axis} - s.{axis}), s.{axis} DESC) AS rn
  FROM (SELECT DISTINCT {axis}, {axis}_idx FROM grid_fx) t CROSS JOIN (SELECT DISTINCT {axis} FROM coarse_coast_fx) s) WHERE rn = 1)"""


add("nearest_grid", ("grid_fx", "coarse_coast_fx"), [_nearest("lat"), _nearest("lon")],
    """SELECT g.scenario, g.time, g.lat_idx, g.lon_idx, g.lat, g.lon, s.mask FROM grid_fx g
JOIN lat_map a ON g.lat = a.lat JOIN lon_map o ON g.lon = o.lon LEFT JOIN coarse_coast_fx s ON s.lat = a.src AND s.lon = o.src""")
_COAST = "coast AS (SELECT a.lat_idx, o.lon_idx, a.lat, o.lon, s.mask FROM coarse_coast_fx s JOIN lat_map a ON s.lat = a.src JOIN lon_map o ON s.lon = o.src)"
add("coast_on_grid", ("grid_fx", "coarse_coast_fx"), [_nearest("lat"), _nearest("lon"), _COAST], "SELECT * FROM coast")


def _pivot(value: str, source: str) -> str:
    columns = ", ".join(
        f"MIN(CASE WHEN hazard = '{h}' AND time = '{t}' THEN {value} END) AS \"{h}_{t}\"" for h in HAZARDS for t in TIMES
    )
    return f"SELECT gadm_id, {columns} FROM {source} GROUP BY gadm_id"


_COLS = ", ".join(f'"{c}"' for c in HAZARD_COLUMNS)
_META1 = "GID_0, COUNTRY, GID_1, NAME_1, ENGTYPE_1, VARNAME_1"
_SEL = "sel AS (SELECT * FROM stats_fx WHERE scoring = '{scale}' AND scenario = '{scenario}')"

add("pivot_time", ("stats_fx",), [_SEL.format(scale="5", scenario="RCP85")], _pivot("score_mean", "sel"))
add("merge_hazards", ("stats_fx",), [_SEL.format(scale="10", scenario="RCP45")], _pivot("score_max", "sel"))
add("attach_metadata", ("stats_fx", "zones_fx"), [_SEL.format(scale="5", scenario="RCP85"), f"w AS ({_pivot('score_mean', 'sel')})"],
    f"SELECT {_META1}, {_COLS} FROM zones_fx z LEFT JOIN w ON z.GID_1 = w.gadm_id")

oracle("threshold_join", " UNION ALL ".join(
    f"SELECT hazard, l_orderkey, l_linenumber, value, '{k}' AS scoring, {by_hazard('value', k)} AS score FROM cells_fx" for k in ("5", "10")
), "cells_fx")

oracle("historical_fill", """SELECT hazard, scenario, time, lat_idx, lon_idx, value FROM cells_fx WHERE scenario <> 'HISTORICAL' AND time <> 'Cc'
UNION ALL SELECT hazard, s.scenario, time, lat_idx, lon_idx, value FROM cells_fx c
  CROSS JOIN (SELECT DISTINCT scenario FROM cells_fx WHERE scenario <> 'HISTORICAL') s WHERE c.scenario = 'HISTORICAL' AND time = 'Cc'""", "cells_fx")

# --- aggregations --------------------------------------------------------------------------------

oracle("ensemble_mean", """SELECT hazard, scenario, time, lat_idx, lon_idx, ROUND(AVG(value), 6) AS value, 'mean' AS statistic
FROM cells_fx GROUP BY hazard, scenario, time, lat_idx, lon_idx""", "cells_fx")
oracle("ensemble_extra_dim", """SELECT hazard, scenario, time, metric AS percentile, lat_idx, lon_idx, ROUND(AVG(value), 6) AS value, 'mean' AS statistic
FROM cells_fx GROUP BY ALL""", "cells_fx")


def _bounds(source: str, value: str, lo=("RCP45", "Cc"), hi=("RCP85", "Lt"), by: str = "") -> str:
    lead = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {lead}COALESCE(MIN(CASE WHEN scenario = '{lo[0]}' AND time = '{lo[1]}' THEN {value} END), "
        f"MIN(CASE WHEN scenario = 'HISTORICAL' AND time = '{lo[1]}' THEN {value} END)) AS lo, "
        f"MAX(CASE WHEN scenario = '{hi[0]}' AND time = '{hi[1]}' THEN {value} END) AS hi FROM {source}{tail}"
    )


oracle("minmax_bounds", _bounds("cells_fx", "value", by="hazard"), "cells_fx")
oracle("hundred_bounds", """SELECT hazard, MIN(CASE WHEN scenario = 'RCP45' AND time = 'Cc' AND score_mean <> 0 THEN score_mean END) AS lo,
MAX(CASE WHEN scenario = 'RCP85' AND time = 'Lt' AND score_mean <> 0 THEN score_mean END) AS hi
FROM stats_fx WHERE scoring = '100' GROUP BY hazard HAVING lo IS NOT NULL AND hi IS NOT NULL AND lo <> hi""", "stats_fx")


def _dense_zonal(source: str, scale: str, score: str, extra: str = "") -> str:
    """Every cell of every zone for every scenario and time, missing ones as 0; two passes."""
    return f"""SELECT {extra}gadm_id, gid0, '{scale}' AS scoring, scenario, time, ROUND(MAX(mu), 6) AS score_mean, ROUND(MAX(s), 6) AS score_max,
ROUND(SQRT(SUM(coverage * (s - mu) * (s - mu)) / SUM(coverage)), 6) AS score_stdev
FROM (SELECT *, SUM(coverage * s) OVER w / SUM(coverage) OVER w AS mu FROM (
  SELECT z.gadm_id, z.gid0, z.coverage, k.scenario, k.time, COALESCE(g.{score}, 0) AS s
  FROM zc z CROSS JOIN (SELECT DISTINCT scenario, time FROM {source}) k
  LEFT JOIN {source} g ON g.scenario = k.scenario AND g.time = k.time AND g.lat_idx = z.lat_idx AND g.lon_idx = z.lon_idx)
  WINDOW w AS (PARTITION BY gadm_id, scenario, time))
GROUP BY gadm_id, gid0, scenario, time"""


def _sparse_zonal(source: str, scale: str, score: str, extra: str = "") -> str:
    """Only the cells that hold a value."""
    return f"""SELECT {extra}gadm_id, gid0, '{scale}' AS scoring, scenario, time, ROUND(MAX(mu), 6) AS score_mean, ROUND(MAX(s), 6) AS score_max,
ROUND(SQRT(SUM(coverage * (s - mu) * (s - mu)) / SUM(coverage)), 6) AS score_stdev
FROM (SELECT *, SUM(coverage * s) OVER w / SUM(coverage) OVER w AS mu FROM (
  SELECT z.gadm_id, z.gid0, z.coverage, g.scenario, g.time, g.{score} AS s
  FROM zc z JOIN {source} g ON g.lat_idx = z.lat_idx AND g.lon_idx = z.lon_idx WHERE g.{score} IS NOT NULL)
  WINDOW w AS (PARTITION BY gadm_id, scenario, time))
GROUP BY gadm_id, gid0, scenario, time"""


_HEAT = "heat AS (SELECT scenario, time, lat_idx, lon_idx, {five} AS s5, {ten} AS s10 FROM grid_fx)".format(
    five=digitize("value", "HS", "5"), ten=digitize("value", "HS", "10")
)
add("zonal_stats", ("edges_fx", "grid_fx"), [*CENTER, _HEAT], _dense_zonal("heat", "5", "s5"))
add("zonal_multi", ("edges_fx", "grid_fx"), [*TOUCHED, _HEAT],
    _dense_zonal("heat", "5", "s5") + " UNION ALL " + _dense_zonal("heat", "10", "s10"))
_MIN_MAX = "heat AS (SELECT scenario, time, lat_idx, lon_idx, {score} AS s5 FROM grid_fx WHERE lat_idx <> 41)"
for _name, _value, _where in (("aggregate_clip", "value", "gid0 IN ('NATION_7', 'NATION_8')"), ("aggregate_countries", "(value / 2)", "gid0 NOT IN ('NATION_3', 'NATION_5')")):
    # Row 41 has the latitude of row 40, so it goes; labels are those of all cells.
    add(_name, ("edges_fx", "grid_fx"), [*CENTER[:-1], _CENTER.replace("AS (SELECT", "AS (SELECT * FROM (SELECT") + f" WHERE {_where})", _MIN_MAX.format(score=digitize(_value, "HS", "5"))],
        _dense_zonal("heat", "5", "s5", "'HS' AS hazard, 1 AS gadm_level, "))
add("aggregate_standard", ("edges_fx", "grid_fx"), [*COVER, _HEAT],
    " UNION ALL ".join(_dense_zonal("heat", k, f"s{k}", "'HS' AS hazard, 1 AS gadm_level, ") for k in ("5", "10")))
_GRID_BOUNDS = f"b AS ({_bounds('grid_fx', 'value')})"
add("zonal_stats_weighted", ("edges_fx", "grid_fx"), [
    *COVER, _GRID_BOUNDS,
    f"h AS (SELECT scenario, time, lat_idx, lon_idx, {minmax('value')} AS s FROM grid_fx, b)",
], _sparse_zonal("h", "100", "s"))

# --- windows, sorts, sets ------------------------------------------------------------------------

_FWI = """fwi AS (SELECT scenario, time, lat_idx, lon_idx,
  CASE WHEN (lat_idx * 7 + lon_idx * 3) % 5 <> 0 AND (FLOOR(lon_idx / 12) + lat_idx) % 3 <> 0 THEN value END AS fwi FROM grid_fx)"""
_DENSE = f"""dense AS (SELECT k.scenario, k.time, k.lat_idx, k.lon_idx, f.fwi FROM (
  SELECT scenario, time, CAST(r AS INT) AS lat_idx, CAST(c AS INT) AS lon_idx
  FROM (SELECT DISTINCT scenario, time FROM fwi) CROSS JOIN range(0, {N_LAT}) t(r)
  CROSS JOIN (SELECT UNNEST(range(0, {N_LON})) AS c)) k
  LEFT JOIN fwi f ON f.scenario = k.scenario AND f.time = k.time AND f.lat_idx = k.lat_idx AND f.lon_idx = k.lon_idx)"""


def _fill(source: str, name: str, along: str, across: str, limit: int) -> list[str]:
    """Forward pass, then a backward pass over its result."""
    w = f"PARTITION BY scenario, time, {across} ORDER BY {along} RANGE BETWEEN"
    return [
        f"{name}_f AS (SELECT scenario, time, lat_idx, lon_idx, LAST_VALUE(fwi IGNORE NULLS) OVER ({w} {limit} PRECEDING AND CURRENT ROW) AS fwi FROM {source})",
        f"{name} AS (SELECT scenario, time, lat_idx, lon_idx, FIRST_VALUE(fwi IGNORE NULLS) OVER ({w} CURRENT ROW AND {limit} FOLLOWING) AS fwi FROM {name}_f)",
    ]


add("densify", ("grid_fx",), [_FWI, _DENSE], "SELECT * FROM dense")
add("gap_fill_lon", ("grid_fx",), [_FWI, *_fill("fwi", "lonf", "lon_idx", "lat_idx", 10)], "SELECT * FROM lonf")
add("gap_fill_2d", ("grid_fx",), [
    _FWI, _DENSE, *_fill("dense", "lonf", "lon_idx", "lat_idx", 5), *_fill("lonf", "latf", "lat_idx", "lon_idx", 5),
], "SELECT * FROM latf")
add("gap_fill_present", ("grid_fx",), [
    _FWI, _DENSE, *_fill("dense", "lonf", "lon_idx", "lat_idx", 5), *_fill("lonf", "latf", "lat_idx", "lon_idx", 5),
], "SELECT * FROM latf WHERE fwi IS NOT NULL")
oracle("sort_grid", "SELECT scenario, time, lat_idx, lon_idx, value FROM grid_fx", "grid_fx")
add("concat_scales", ("grid_fx",), [_GRID_BOUNDS],
    f"""SELECT scenario, time, lat_idx, lon_idx, '5' AS scoring, {digitize('value', 'HS', '5')} AS score, CAST(NULL AS VARCHAR) AS statistic FROM grid_fx
UNION ALL SELECT scenario, time, lat_idx, lon_idx, '100', ROUND({minmax('value')}, 6), 'mean' FROM grid_fx, b""")

# --- scalar functions ----------------------------------------------------------------------------

oracle("score_asc", f"SELECT l_orderkey, l_linenumber, {digitize('value', 'ER', '5')} AS score FROM cells_fx", "cells_fx")
oracle("score_desc", f"SELECT l_orderkey, l_linenumber, {digitize('rp', 'CF', '5')} AS score FROM cells_fx", "cells_fx")


def _edge_scores() -> str:
    from hazardgrid.queries import EDGE_TABLES

    scores = ", ".join(f"{digitize('v', h, k, t)} AS s_{h.lower()}_{k}" for h, k, t in EDGE_TABLES)
    v = f"CASE WHEN rp IS NULL THEN NULL WHEN rp > 1e9 THEN rp WHEN l_linenumber = 1 THEN {_num(-inf)} ELSE value - 20 END"
    return f"SELECT l_orderkey, l_linenumber, {scores} FROM (SELECT l_orderkey, l_linenumber, {v} AS v FROM cells_fx)"


oracle("score_edges", _edge_scores(), "cells_fx")
add("score_minmax", ("cells_fx",), [f"b AS ({_bounds('cells_fx', 'value', ('RCP85', 'Cc'), ('RCP85', 'Lt'), 'hazard')})"],
    f"SELECT {_CELL_LABELS}, '100' AS scoring, ROUND({minmax('value')}, 6) AS score FROM cells_fx JOIN b USING (hazard)")
oracle("protect_clamp", f"""SELECT scenario, time, g.lat_idx, g.lon_idx,
CASE WHEN value IS NULL OR protection IS NULL THEN NULL ELSE GREATEST({digitize('value', 'HS', '10')} - protection * 2, 0) END AS score
FROM grid_fx g JOIN static_fx s ON g.lat_idx = s.lat_idx AND g.lon_idx = s.lon_idx""", "grid_fx", "static_fx")


def classes(x: str, bins) -> str:
    arms = " ".join(f"WHEN {x} <= {_num(b)} THEN {i}" for i, b in enumerate(bins, start=1))
    return f"CASE WHEN {x} IS NULL OR {x} <= 0 THEN 0 {arms} ELSE 5 END"


oracle("rescore_quantiles", f"SELECT l_orderkey, l_linenumber, {classes('((value - 10) / 10000)', (0.0005, 0.001, 0.002, 0.003))} AS class FROM cells_fx", "cells_fx")


def _rounded(scale: str, column: str) -> str:
    if column == "score_stdev":
        return f"round_even(CAST({column} AS DOUBLE), 4)"
    return f"round_even(CAST({column} AS DOUBLE), {2 if scale == '100' else 0})"


oracle("round_scores", "SELECT hazard, gadm_id, scoring, scenario, time, " + ", ".join(
    f"CASE WHEN scoring = '100' THEN {_rounded('100', c)} ELSE {_rounded('5', c)} END AS {c}" for c in ("score_mean", "score_max", "score_stdev")
) + " FROM stats_fx", "stats_fx")
_HB = """hb AS (SELECT hazard, MIN(CASE WHEN scenario = 'RCP45' AND time = 'Cc' AND {v} <> 0 THEN {v} END) AS lo,
  MAX(CASE WHEN scenario = 'RCP85' AND time = 'Lt' AND {v} <> 0 THEN {v} END) AS hi FROM {source} GROUP BY hazard
  HAVING lo IS NOT NULL AND hi IS NOT NULL AND lo <> hi)"""
_STRETCH = "CASE WHEN {v} <> 0 AND lo IS NOT NULL THEN round_even(LEAST(GREATEST(({v} - lo) / (hi - lo) * 100, 0), 100), 2) ELSE {v} END"
add("normalize_hundred", ("stats_fx",), ["l AS (SELECT * FROM stats_fx WHERE scoring = '100')", _HB.format(v="score_mean", source="l")],
    f"SELECT hazard, gadm_id, scenario, time, {_STRETCH.format(v='score_mean')} AS score_mean FROM l LEFT JOIN hb USING (hazard)")

# --- scoring jobs --------------------------------------------------------------------------------


def _score_standard() -> str:
    parts = []
    for code, s in SETTINGS.items():
        if s.kind != "standard":
            continue
        v = f"value * {_num(s.scale_factor)}" if s.scale_factor else "value"
        metric = f" AND metric = '{s.metric_select}'" if s.metric_select else ""
        labels = _CELL_LABELS.replace("metric", "CAST(NULL AS VARCHAR) AS metric") if s.metric_select else _CELL_LABELS
        rows = f"(SELECT * REPLACE ({v} AS value) FROM cells_fx WHERE hazard = '{code}'{metric})"
        parts += [f"SELECT {labels}, '{k}' AS scoring, {digitize('value', code, k)} AS score FROM {rows}" for k in ("5", "10")]
        bounds = _bounds(rows, "value", ("RCP85", s.ref_time or "Cc"), ("RCP85", s.ref_time or "Lt"))
        parts.append(f"SELECT {labels}, '100' AS scoring, ROUND({minmax('value')}, 6) AS score FROM {rows}, ({bounds}) b")
    return " UNION ALL ".join(parts)


oracle("score_standard", _score_standard(), "cells_fx")

_SUB = "sub AS (SELECT scenario, time, statistic, model, metric, lat_idx, lon_idx, value / 10 AS v FROM cells_fx)"
_SUB_LABELS = "scenario, time, statistic, model, metric, lat_idx, lon_idx"
add("score_sub", ("cells_fx",), [_SUB, f"b AS ({_bounds('sub', 'v', ('RCP85', 'Cc'))})"],
    f"""SELECT {_SUB_LABELS}, '5' AS scoring, {digitize('v', 'SUB', '5')} AS score FROM sub
UNION ALL SELECT {_SUB_LABELS}, '10', {digitize('v * 2', 'SUB', '10')} FROM sub
UNION ALL SELECT {_SUB_LABELS}, '100', ROUND({minmax('v')}, 6) FROM sub, b""")

_PLAIN = "scenario, time, lat_idx, lon_idx"


def _three_scales(source: str, five: str, ten: str, hundred: str) -> str:
    return f"""SELECT {_PLAIN}, '5' AS scoring, {five} AS score FROM {source}
UNION ALL SELECT {_PLAIN}, '10', {ten} FROM {source} UNION ALL SELECT {_PLAIN}, '100', ROUND({hundred}, 6) FROM {source}, b"""


def _product(scale: str) -> str:
    return f"({digitize('value', 'LS', scale, 'thresholds_ari')}) * ({digitize('protection', 'LS', scale, 'thresholds_susceptibility')})"


add("score_ls", ("grid_fx", "static_fx"), [
    f"""ls AS (SELECT scenario, time, g.lat_idx, g.lon_idx, {_product('5')} AS c5, {_product('10')} AS c10
  FROM grid_fx g JOIN static_fx s ON g.lat_idx = s.lat_idx AND g.lon_idx = s.lon_idx)""",
    f"b AS ({_bounds('ls', 'c5', ('RCP85', 'Cc'))})",
], _three_scales("ls", digitize("c5", "LS", "5", "thresholds_final"), digitize("c10", "LS", "10", "thresholds_final"), minmax("c5")))

add("score_wf", ("grid_fx", "static_fx"), [
    _FWI, _DENSE, *_fill("dense", "lonf", "lon_idx", "lat_idx", 30), *_fill("lonf", "latf", "lat_idx", "lon_idx", 30),
    """wf AS (SELECT f.scenario, f.time, f.lat_idx, f.lon_idx, protection * fwi AS c FROM latf f
  JOIN static_fx s ON f.lat_idx = s.lat_idx AND f.lon_idx = s.lon_idx WHERE protection IS NOT NULL)""",
    f"b AS ({_bounds('wf', 'c', ('RCP85', 'Cc'))})",
], _three_scales("wf", digitize("c", "WF", "5"), digitize("c", "WF", "10"), minmax("c")))

_MEAN = "mean_rp AS (SELECT scenario, time, lat_idx, lon_idx, AVG(rp) AS v FROM cells_fx GROUP BY 1, 2, 3, 4)"
_FILLED = """inun AS (SELECT * FROM mean_rp WHERE scenario <> 'HISTORICAL' AND time <> 'Cc' UNION ALL
  SELECT s.scenario, time, lat_idx, lon_idx, v FROM mean_rp m CROSS JOIN (SELECT DISTINCT scenario FROM cells_fx WHERE scenario <> 'HISTORICAL') s
  WHERE m.scenario = 'HISTORICAL' AND time = 'Cc')"""
_KEPT = "inun AS (SELECT * FROM mean_rp)"


def _flood_ctes(code: str) -> list[str]:
    def lowered(score: str, scale: str) -> str:
        return (
            f"CASE WHEN ({score}) IS NULL OR protection IS NULL THEN NULL "
            f"ELSE GREATEST(({score}) - protection * {PROTECTION_FACTOR[scale]}, 0) END"
        )

    return [
        _MEAN, _FILLED if code == "RF" else _KEPT, f"b AS ({_bounds('inun', 'v', ('RCP85', 'Cc'))})",
        f"""fl AS (SELECT i.scenario, i.time, i.lat_idx, i.lon_idx, {lowered(digitize('v', code, '5'), '5')} AS s5,
  {lowered(digitize('v', code, '10'), '10')} AS s10, {lowered(minmax('v'), '100')} AS s100
  FROM inun i JOIN static_fx s ON i.lat_idx = s.lat_idx AND i.lon_idx = s.lon_idx, b)""",
    ]


for _code, _key in (("RF", "score_rf"), ("CF", "score_cf")):
    add(_key, ("cells_fx", "static_fx"), _flood_ctes(_code), " UNION ALL ".join(
        f"SELECT {_PLAIN}, 'mean' AS statistic, '{k}' AS scoring, ROUND(s{k}, 6) AS score FROM fl" for k in ("5", "10", "100")
    ))

# Stored scores are single precision.
_HP = "hp AS (SELECT scenario, time, lat_idx, lon_idx, value / 64 * 100 AS v FROM cells_fx WHERE metric = 'p95')"
add("score_hazard", ("cells_fx",), [_HP, f"b AS ({_bounds('hp', 'v', ('RCP85', 'Cc'))})"], " UNION ALL ".join(
    f"SELECT 'HP' AS hazard, '{k}' AS scoring, {_PLAIN}, ROUND(CAST(CAST({e} AS FLOAT) AS DOUBLE), 3) AS score FROM hp{', b' if k == '100' else ''}"
    for k, e in (("5", digitize("v", "HP", "5")), ("10", digitize("v", "HP", "10")), ("100", minmax("v")))
))

# --- weighted aggregation ------------------------------------------------------------------------


def _weight(score: str, scale: str) -> str:
    arms = " ".join(f"WHEN {score} = {k} THEN {_num(w)}" for k, w in RP_WEIGHTS[scale].items())
    return f"CASE {arms} END"


def _risk(scale: str, coast: str | None = None) -> str:
    """Weighted risk on the dense product of zone cells and labels."""
    share = "n_coast" if coast else "SUM(CASE WHEN s IS NOT NULL THEN coverage END)"
    join = f"LEFT JOIN (SELECT z.gadm_id, SUM(z.coverage) AS n_coast FROM zc z JOIN {coast} c ON c.lat_idx = z.lat_idx AND c.lon_idx = z.lon_idx WHERE c.mask > 0 GROUP BY 1) nc ON nc.gadm_id = d.gadm_id" if coast else ""
    group = ", n_coast" if coast else ""
    return f"""SELECT gadm_id, gid0, scenario, time, 'mean' AS statistic, '{scale}' AS scoring, top AS score_max,
  CASE WHEN n > 0 AND {_weight('FLOOR(top)', scale)} IS NOT NULL THEN LEAST(w / n, {_weight('FLOOR(top)', scale)}) END AS weighted_risk
FROM (SELECT d.gadm_id, d.gid0, scenario, time, MAX(s) AS top, COALESCE(SUM(({_weight('s', scale)}) * coverage), 0) AS w, {share} AS n
  FROM (SELECT z.gadm_id, z.gid0, z.coverage, k.scenario, k.time, f.s{scale} AS s FROM zc z
    CROSS JOIN (SELECT DISTINCT scenario, time FROM fl) k
    LEFT JOIN fl f ON f.scenario = k.scenario AND f.time = k.time AND f.lat_idx = z.lat_idx AND f.lon_idx = z.lon_idx) d {join}
  GROUP BY d.gadm_id, d.gid0, scenario, time{group})"""


def _classes(code: str, source: str, extra: str = "") -> str:
    score = classes("weighted_risk", QUANTILE_BINS[code, 1, "5"])
    return f"""SELECT {extra}gadm_id, gid0, scenario, time, statistic, scoring, ROUND(score_max, 6) AS score_max,
CAST({score} AS DOUBLE) AS score_mean, CAST(NULL AS DOUBLE) AS score_stdev FROM ({source})"""


_FLOOD_VIEWS = ("cells_fx", "static_fx", "edges_fx")
add("rp_weighted_rf", (*_FLOOD_VIEWS, "zones_fx"), [
    *_flood_ctes("RF"), *CENTER, f"known AS ({_classes('RF', _risk('5'))})",
    """listed AS (SELECT UNNEST([GID_1, GID_1 || '_islet']) AS gadm_id, GID_0 AS gid0 FROM zones_fx),
labels AS (SELECT DISTINCT scenario, time FROM fl)""",
], """SELECT gadm_id, gid0, scenario, time, statistic, scoring, score_max, score_mean, score_stdev FROM known
UNION ALL SELECT l.gadm_id, l.gid0, k.scenario, k.time, 'mean', '5', NULL, CAST(0 AS DOUBLE), NULL
FROM listed l CROSS JOIN labels k WHERE l.gadm_id NOT IN (SELECT gadm_id FROM known)""")
add("rp_weighted_cf", (*_FLOOD_VIEWS, "coast_fx"), [*_flood_ctes("CF"), *CENTER], _classes("CF", _risk("5", "coast_fx")))
add("weighted_risk", _FLOOD_VIEWS, [*_flood_ctes("RF"), *COVER],
    " UNION ALL ".join(
        f"SELECT * REPLACE (ROUND(score_max, 7) AS score_max, ROUND(weighted_risk, 7) AS weighted_risk) FROM ({_risk(k)})" for k in ("5", "10")
    ))
add("calibrate_bins", _FLOOD_VIEWS, [*_flood_ctes("RF"), *CENTER, f"risk AS ({_risk('5')} UNION ALL {_risk('10')})"],
    "SELECT scoring, " + ", ".join(f"ROUND(list_sort(list(weighted_risk))[CAST(CEIL(COUNT(*) * 0.{q}) AS BIGINT)], 7) AS q{q}0" for q in (2, 4, 6, 8))
    + " FROM risk WHERE weighted_risk > 0 GROUP BY scoring")
oracle("quantiles_exact", "SELECT hazard, scenario, " + ", ".join(
    f"list_sort(list(v))[CAST(GREATEST(CEIL(COUNT(*) * {p}), 1) AS BIGINT)] AS {n}" for n, p in (("least", "0"), ("q25", "0.25"), ("q50", "0.5"), ("q90", "0.9"), ("most", "1")))
    + " FROM (SELECT CASE WHEN hazard <> 'WS' THEN hazard END AS hazard, scenario, CAST(l_orderkey * 10 + l_linenumber AS DOUBLE) AS v FROM cells_fx) GROUP BY hazard, scenario", "cells_fx")


def _hundred_part(code: str) -> str:
    zonal = _sparse_zonal("fl", "100", "s100", f"'{code}' AS hazard, 1 AS gadm_level, ")
    return f"SELECT hazard, gadm_level, gadm_id, gid0, scoring, scenario, time, score_mean, score_max, score_stdev FROM ({zonal})"


def _class_part(code: str, coast: str | None = None) -> str:
    rows = _classes(code, _risk("5", coast), f"'{code}' AS hazard, 1 AS gadm_level, ")
    return f"SELECT hazard, gadm_level, gadm_id, gid0, scoring, scenario, time, score_mean, score_max, score_stdev FROM ({rows})"


add("aggregate_rf", _FLOOD_VIEWS, [*_flood_ctes("RF"), *CENTER], f"{_class_part('RF')} UNION ALL {_hundred_part('RF')}")
add("aggregate_cf", (*_FLOOD_VIEWS, "grid_fx", "coarse_coast_fx"), [*_flood_ctes("CF"), *CENTER, _nearest("lat"), _nearest("lon"), _COAST],
    f"{_class_part('CF', 'coast')} UNION ALL {_hundred_part('CF')}")

# --- combination ---------------------------------------------------------------------------------


def _filled(kind: str) -> str:
    return ", ".join(f'CAST(COALESCE("{c}", 0) AS {kind}) AS "{c}"' for c in HAZARD_COLUMNS)


def _combined(column: str, scale: str, scenario: str, views=("stats_fx", "zones_fx"), kind: str = "INT", meta: str = _META1) -> str:
    stats, zones = views
    key = "GID_1" if "GID_1" in meta else "GID_0"
    return _with(views, [
        f"sel AS (SELECT hazard, time, gadm_id, {_rounded(scale, column)} AS v FROM {stats} WHERE scoring = '{scale}' AND scenario = '{scenario}')",
        f"w AS ({_pivot('v', 'sel')})",
    ], f"SELECT {meta}, {_filled(kind)} FROM {zones} z LEFT JOIN w ON z.{key} = w.gadm_id")


ORACLES["combined_mean"] = _combined("score_mean", "5", "RCP85")
ORACLES["write_combined"] = ORACLES["combined_mean"]
add("combined_first", ("stats_fx", "zones_fx"), [
    """o AS (SELECT hazard, time, gadm_id, scenario, score_mean FROM stats_fx
  WHERE scoring = '5' AND scenario <> 'HISTORICAL' AND (scenario = 'RCP85' OR time <> 'Mt'))""",
    f"sel AS (SELECT hazard, time, gadm_id, {_rounded('5', 'score_mean')} AS v FROM o QUALIFY ROW_NUMBER() OVER (PARTITION BY hazard, time, gadm_id ORDER BY scenario) = 1)",
    f"w AS ({_pivot('v', 'sel')})",
], f"SELECT {_META1}, {_filled('INT')} FROM zones_fx z LEFT JOIN w ON z.GID_1 = w.gadm_id")
ORACLES["combined_max"] = _combined("score_max", "10", "RCP45")
ORACLES["combined_std"] = _combined("score_stdev", "10", "RCP85", kind="DOUBLE")
_DISTRICT_HEAT = _dense_zonal("heat", "5", "s5")
add("combined_district", ("districts_fx", "district_edges_fx", "grid_fx"), [
    _EDGES.replace("edges_fx", "district_edges_fx"), *CENTER[1:], _HEAT, f"zd AS ({_DISTRICT_HEAT})",
    "sel AS (SELECT 'HS' AS hazard, time, gadm_id, round_even(CAST(score_mean AS DOUBLE), 0) AS v FROM zd WHERE scenario = 'RCP85')",
    f"w AS ({_pivot('v', 'sel')})",
], f"SELECT GID_0, COUNTRY, GID_1, NAME_1, GID_2, NAME_2, {_filled('INT')} FROM districts_fx z LEFT JOIN w ON z.GID_2 = w.gadm_id")
ORACLES["combined_country"] = _combined("score_mean", "5", "RCP45", ("country_stats_fx", "countries_fx"), meta="GID_0, COUNTRY")
add("combined_hundred", ("stats_fx", "zones_fx"), [
    f"l AS (SELECT hazard, scenario, time, gadm_id, {_rounded('100', 'score_mean')} AS v FROM stats_fx JOIN zones_fx ON gadm_id = GID_1 WHERE scoring = '100')",
    _HB.format(v="v", source="l"),
    f"s AS (SELECT hazard, time, gadm_id, {_STRETCH.format(v='v')} AS v FROM l LEFT JOIN hb USING (hazard) WHERE scenario = 'RCP45')",
    f"w AS ({_pivot('v', 's')})",
], f"SELECT {_META1}, {_filled('DOUBLE')} FROM zones_fx z LEFT JOIN w ON z.GID_1 = w.gadm_id")

# --- the whole run -------------------------------------------------------------------------------

# Province means over all cells of the province, absent ones as 0; classes for the floods.
_RUN_RP = "('CF', 'RF', 'TC', 'TS')"
_RUN = f"""src AS (SELECT hazard, scenario, time, lat_idx, lon_idx,
  (CASE WHEN hazard IN {_RUN_RP} THEN rp ELSE value END) / (CASE hazard WHEN 'HP' THEN 64 WHEN 'SUB' THEN 10 ELSE 1 END) AS v FROM hazard_grid_fx)"""


def _of(code: str, columns: str = "scenario, time, lat_idx, lon_idx, v") -> str:
    return f"(SELECT {columns} FROM src WHERE hazard = '{code}')"


_RUN_FIRE = [
    f"fwi AS {_of('WF', 'scenario, time, lat_idx, lon_idx, v AS fwi')}",
    _DENSE, *_fill("dense", "lonf", "lon_idx", "lat_idx", 30), *_fill("lonf", "latf", "lat_idx", "lon_idx", 30),
    """wf AS (SELECT f.scenario, f.time, f.lat_idx, f.lon_idx, protection * fwi AS v FROM latf f
  JOIN static_fx s ON f.lat_idx = s.lat_idx AND f.lon_idx = s.lon_idx WHERE protection IS NOT NULL)""",
]


def _run_scores(scale: str) -> list[str]:
    """Scores of all hazards but the floods, and a table of scores for each flood."""
    parts, ctes = [], []
    for code, s in SETTINGS.items():
        if s.kind in ("special_rf", "special_cf"):
            continue
        rows = {"special_ls": f"""(SELECT scenario, time, l.lat_idx, l.lon_idx, ({digitize('v', 'LS', '5', 'thresholds_ari')}) * ({digitize('protection', 'LS', '5', 'thresholds_susceptibility')}) AS v
  FROM {_of('LS')} l JOIN static_fx s ON l.lat_idx = s.lat_idx AND l.lon_idx = s.lon_idx)""", "special_wf": "wf"}.get(s.kind, _of(code))
        if scale == "100":
            v = f"v * {_num(s.scale_factor)}" if s.scale_factor else "v"
            source = f"(SELECT scenario, time, lat_idx, lon_idx, {v} AS v FROM {rows})"
            bounds = _bounds(source, "v", ("RCP85", s.ref_time or "Cc"), ("RCP85", s.ref_time or "Lt"))
            ctes += [f"v_{code} AS (SELECT * FROM {source})", f"b_{code} AS ({bounds.replace(source, f'v_{code}')})"]
            parts.append(f"SELECT '{code}' AS hazard, scenario, time, lat_idx, lon_idx, CAST(CAST({minmax('v')} AS FLOAT) AS DOUBLE) AS s FROM v_{code}, b_{code}")
        else:
            v = f"v * {_num(s.scale_factor)}" if s.scale_factor else "v"
            score = digitize(v, code, scale, "thresholds_final" if code == "LS" else None)
            parts.append(f"SELECT '{code}' AS hazard, scenario, time, lat_idx, lon_idx, {score} AS s FROM {rows}")
    ctes.append(f"sg AS ({' UNION ALL '.join(parts)})")
    filled = """SELECT scenario, time, lat_idx, lon_idx, v FROM {0} WHERE scenario <> 'HISTORICAL' AND time <> 'Cc' UNION ALL
  SELECT k.scenario, time, lat_idx, lon_idx, v FROM {0} m CROSS JOIN (SELECT DISTINCT scenario FROM {0} WHERE scenario <> 'HISTORICAL') k
  WHERE m.scenario = 'HISTORICAL' AND time = 'Cc'""".format(_of("RF"))
    for code, rows in (("RF", f"({filled})"), ("CF", _of("CF"))):
        ctes += [f"i_{code} AS (SELECT * FROM {rows})", f"bf_{code} AS ({_bounds(f'i_{code}', 'v', ('RCP85', 'Cc'))})"]
        score = minmax("v") if scale == "100" else digitize("v", code, scale)
        lowered = f"CASE WHEN ({score}) IS NULL OR protection IS NULL THEN NULL ELSE GREATEST(({score}) - protection * {PROTECTION_FACTOR[scale]}, 0) END"
        ctes.append(f"""f_{code} AS (SELECT i.scenario, i.time, i.lat_idx, i.lon_idx, CAST(CAST({lowered} AS FLOAT) AS DOUBLE) AS s{scale}
  FROM i_{code} i JOIN static_fx s ON i.lat_idx = s.lat_idx AND i.lon_idx = s.lon_idx, bf_{code})""")
    return ctes


_RUN_ZONES = """zw AS (SELECT gadm_id, gid0, SUM(coverage) AS total FROM zc GROUP BY ALL),
zs AS (SELECT k.gadm_id, k.hazard, k.scenario, k.time, COALESCE(SUM(z.s * z.coverage), 0) / ANY_VALUE(k.total) AS m
  FROM (SELECT zw.*, l.* FROM zw CROSS JOIN (SELECT DISTINCT hazard, scenario, time FROM sg) l) k
  LEFT JOIN (SELECT zc.gadm_id, zc.coverage, sg.* FROM zc JOIN sg USING (lat_idx, lon_idx)) z
    ON z.gadm_id = k.gadm_id AND z.hazard = k.hazard AND z.scenario = k.scenario AND z.time = k.time
  GROUP BY 1, 2, 3, 4)"""
_RUN_VIEWS = ("hazard_grid_fx", "static_fx", "edges_fx", "zones_fx", "coarse_coast_fx")


def _run_coast() -> list[str]:
    return [x.replace("grid_fx", "f_CF_axes") for x in (_nearest("lat"), _nearest("lon"))] + [_COAST]


_CF_AXES = "f_CF_axes AS (SELECT lat_idx, lon_idx, lat_idx + CAST(0.5 AS DOUBLE) AS lat, lon_idx + CAST(0.5 AS DOUBLE) AS lon FROM f_CF)"
_FIVE_STATS = "SELECT gadm_id, hazard, time, round_even(CAST(m AS DOUBLE), 0) AS v FROM zs WHERE scenario = 'RCP85'" + "".join(
    f" UNION ALL SELECT gadm_id, '{code}', time, score_mean FROM ({_classes(code, _risk('5', coast).replace(' fl', f' f_{code}'))}) WHERE scenario = 'RCP85'"
    for code, coast in (("RF", None), ("CF", "coast"))
)
add("full_run_five", _RUN_VIEWS, [_RUN, *_RUN_FIRE, *_run_scores("5"), *CENTER, _CF_AXES, *_run_coast(), _RUN_ZONES, f"st AS ({_FIVE_STATS})", f"w AS ({_pivot('v', 'st')})"],
    f"SELECT {_META1}, {_filled('INT')} FROM zones_fx z LEFT JOIN w ON z.GID_1 = w.gadm_id")
_TEN = " UNION ALL ".join(
    f"SELECT '{code}' AS hazard, gadm_id, scenario, time, ROUND(weighted_risk, 12) AS x FROM ({_risk('10', coast).replace(' fl', f' f_{code}')})"
    for code, coast in (("RF", None), ("CF", "coast"))
)
add("full_run_ten", _RUN_VIEWS, [
    _RUN, *_RUN_FIRE, *_run_scores("10"), *CENTER, _CF_AXES, *_run_coast(), f"risk AS ({_TEN})",
    "cut AS (SELECT hazard, " + ", ".join(f"list_sort(list(x))[CAST(CEIL(COUNT(*) * 0.{q}) AS BIGINT)] AS q{q}" for q in (2, 4, 6, 8)) + " FROM risk WHERE x > 0 GROUP BY hazard)",
    """st AS (SELECT gadm_id, hazard, time, CASE WHEN x IS NULL OR x <= 0 THEN 0 WHEN x <= q2 THEN 1 WHEN x <= q4 THEN 2 WHEN x <= q6 THEN 3 WHEN x <= q8 THEN 4 ELSE 5 END AS v
  FROM risk JOIN cut USING (hazard) WHERE scenario = 'RCP85')""",
    f"w AS ({_pivot('v', 'st')})",
], f"SELECT {_META1}, {_filled('INT')} FROM zones_fx z LEFT JOIN w ON z.GID_1 = w.gadm_id")
_FLOOD_MEANS = " UNION ALL ".join(
    f"""SELECT gadm_id, '{code}' AS hazard, scenario, time, SUM(coverage * s100) / SUM(coverage) AS m FROM zc JOIN f_{code} USING (lat_idx, lon_idx)
  WHERE s100 IS NOT NULL GROUP BY ALL""" for code in ("RF", "CF")
)
add("full_run_hundred", _RUN_VIEWS, [
    _RUN, *_RUN_FIRE, *_run_scores("100"), *CENTER, _RUN_ZONES,
    f"l AS (SELECT gadm_id, hazard, scenario, time, round_even(CAST(m AS DOUBLE), 2) AS v FROM (SELECT * FROM zs UNION ALL {_FLOOD_MEANS}) WHERE gadm_id IN (SELECT GID_1 FROM zones_fx))",
    _HB.format(v="v", source="l"),
    f"st AS (SELECT hazard, time, gadm_id, {_STRETCH.format(v='v')} AS v FROM l LEFT JOIN hb USING (hazard) WHERE scenario = 'RCP85')",
    f"w AS ({_pivot('v', 'st')})",
], f"SELECT {_META1}, {_filled('DOUBLE')} FROM zones_fx z LEFT JOIN w ON z.GID_1 = w.gadm_id")


# All tables of a run: both scales, three statistics, two scenarios.
_RUN_SPREAD = """zs AS (SELECT gadm_id, hazard, scenario, time, m, top, SQRT(GREATEST(sq / total - m * m, 0)) AS sd
  FROM (SELECT k.gadm_id, k.hazard, k.scenario, k.time, ANY_VALUE(k.total) AS total, COALESCE(SUM(z.s * z.coverage), 0) / ANY_VALUE(k.total) AS m,
    COALESCE(MAX(z.s), 0) AS top, COALESCE(SUM(z.s * z.s * z.coverage), 0) AS sq
  FROM (SELECT zw.*, l.* FROM zw CROSS JOIN (SELECT DISTINCT hazard, scenario, time FROM sg) l) k
  LEFT JOIN (SELECT zc.gadm_id, zc.coverage, sg.* FROM zc JOIN sg USING (lat_idx, lon_idx)) z
    ON z.gadm_id = k.gadm_id AND z.hazard = k.hazard AND z.scenario = k.scenario AND z.time = k.time
  GROUP BY 1, 2, 3, 4))"""
_RUN_TOTALS = _RUN_ZONES.split(",\nzs AS")[0]
_LONG = "SELECT gadm_id, hazard, scenario, time, m, top, sd FROM zs UNION ALL "
_FIVE_ALL = _LONG + " UNION ALL ".join(
    f"SELECT gadm_id, '{code}', scenario, time, score_mean, score_max, score_stdev FROM ({_classes(code, _risk('5', coast).replace(' fl', f' f_{code}'))})"
    for code, coast in (("RF", None), ("CF", "coast"))
)
_HUNDRED_ALL = _LONG + " UNION ALL ".join(
    f"""SELECT gadm_id, '{code}', scenario, time, mu, MAX(s100), SQRT(SUM(coverage * (s100 - mu) * (s100 - mu)) / SUM(coverage))
  FROM (SELECT *, SUM(coverage * s100) OVER w / SUM(coverage) OVER w AS mu FROM zc JOIN f_{code} USING (lat_idx, lon_idx) WHERE s100 IS NOT NULL
    WINDOW w AS (PARTITION BY gadm_id, scenario, time)) GROUP BY gadm_id, scenario, time, mu""" for code in ("RF", "CF")
)


def _run_tables(scale: str) -> str:
    """The six tables of one scale."""
    long = _FIVE_ALL if scale == "5" else _HUNDRED_ALL
    places = {"mean": 0, "max": 0, "std": 4} if scale == "5" else {"mean": 2, "max": 2, "std": 4}
    ctes = [_RUN, *_RUN_FIRE, *_run_scores(scale), *CENTER, _CF_AXES.replace("s5", f"s{scale}"), *_run_coast(), _RUN_TOTALS, _RUN_SPREAD,
            f"al AS (SELECT * FROM ({long}) WHERE scenario <> 'HISTORICAL' AND gadm_id IN (SELECT GID_1 FROM zones_fx))"]
    parts = []
    for stat, column in (("mean", "m"), ("max", "top"), ("std", "sd")):
        ctes.append(f"l_{stat} AS (SELECT gadm_id, hazard, scenario, time, round_even(CAST({column} AS DOUBLE), {places[stat]}) AS v FROM al)")
        if scale == "100":
            ctes.append(_HB.format(v="v", source=f"l_{stat}").replace("hb AS", f"hb_{stat} AS"))
            ctes.append(f"st_{stat} AS (SELECT gadm_id, hazard, scenario, time, {_STRETCH.format(v='v')} AS v FROM l_{stat} LEFT JOIN hb_{stat} USING (hazard))")
        for scenario in ("RCP45", "RCP85"):
            source = f"(SELECT * FROM {'st' if scale == '100' else 'l'}_{stat} WHERE scenario = '{scenario}')"
            parts.append(f"""SELECT '{scale}' AS scale, '{stat}' AS stat, '{scenario}' AS scenario, {_META1}, {_filled('DOUBLE')}
FROM zones_fx z LEFT JOIN ({_pivot('v', source)}) w ON z.GID_1 = w.gadm_id""")
    return _with(_RUN_VIEWS, ctes, " UNION ALL ".join(parts))


ORACLES["flagship"] = " UNION ALL ".join(f"SELECT * FROM ({_run_tables(scale)})" for scale in ("5", "100"))
