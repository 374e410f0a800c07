"""The driver's tables recast as cells, zones, coast and statistics.

The view texts are plain SQL that Spark and the checking database both accept. Raster width,
zones and edges follow the sizes of the tables, so every operator's work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazardgrid.schema import GridSpec

N_LAT = 60

_HAZARD_CASE = """CASE (l_orderkey + l_partkey) % 14
  WHEN 0 THEN 'CER' WHEN 1 THEN 'CF' WHEN 2 THEN 'CS' WHEN 3 THEN 'DR' WHEN 4 THEN 'ER'
  WHEN 5 THEN 'HP' WHEN 6 THEN 'HS' WHEN 7 THEN 'LS' WHEN 8 THEN 'RF' WHEN 9 THEN 'SUB'
  WHEN 10 THEN 'TC' WHEN 11 THEN 'TS' WHEN 12 THEN 'WF' ELSE 'WS' END"""

# Offsets of ring vertices from a province's centre: x, y and how far y shifts with the province.
_OUTER = ((-4.3, -3.1, 0), (3.7, -2.2, 0), (2.1, 3.9, 0.3), (-0.4, 0.8, 0), (-3.6, 4.4, 0.3))
_HOLE = ((-1.8, -1.8, 0), (-1.8, -0.2, 0), (-0.2, -0.2, 0), (-0.2, -1.8, 0))


def _outline() -> str:
    """Edges of both province shapes as rows."""
    rows = []
    for shape, rings in (("plain", (_OUTER,)), ("holed", (_OUTER, _HOLE))):
        for ring, points in enumerate(rings):
            for seq, (a, b) in enumerate(zip(points, points[1:] + points[:1], strict=True)):
                rows.append((f"'{shape}'", ring, seq, *a, *b))
    names = ("shape", "ring", "seq", "ax", "ay", "af", "bx", "by_", "bf")
    return " UNION ALL ".join(
        "SELECT " + ", ".join(f"{v} AS {n}" for v, n in zip(row, names, strict=True)) for row in rows
    )


# Rings of rectangles on quarters of a cell: part, ring, left, bottom, right, top.
_BOXES = ((0, 0, -4, -3.5, 3.25, 2.75), (0, 1, -3.25, -2.5, 1.5, 1.25), (1, 0, 3.25, -1.25, 5.5, 1.5), (2, 0, -2.5, -1.75, 0.75, 0.25))


def _boxes() -> str:
    """Edges of the rectangles as rows, anticlockwise; once for odd and once for even zones, to join on."""
    rows = []
    for odd, (part, ring, left, bottom, right, top) in ((odd, box) for odd in (0, 1) for box in _BOXES):
        points = ((left, bottom), (right, bottom), (right, top), (left, top))
        for seq, ((ax, ay), (bx, by)) in enumerate(zip(points, points[1:] + points[:1], strict=True)):
            numbers = ", ".join(f"CAST({v} AS DOUBLE) AS {n}" for v, n in ((ax, "ax"), (ay, "ay"), (bx, "bx"), (by, "by_")))
            rows.append(f"SELECT {odd} AS odd, {part} AS part, {ring} AS ring, {seq} AS seq, {numbers}")
    return " UNION ALL ".join(rows)


def _quarters() -> str:
    """Edges of the two districts of a province as rows: boxes beside each other, with a gap."""
    rows = []
    for half, left in ((1, -4.25), (2, 0.25)):
        points = ((left, -2.75), (left + 3.5, -2.75), (left + 3.5, 2.25), (left, 2.25))
        for odd in (0, 1):
            for seq, ((ax, ay), (bx, by)) in enumerate(zip(points, points[1:] + points[:1], strict=True)):
                numbers = ", ".join(f"CAST({v} AS DOUBLE) AS {n}" for v, n in ((ax, "ax"), (ay, "ay"), (bx, "bx"), (by, "by_")))
                rows.append(f"SELECT {odd} AS odd, {half} AS half, {seq} AS seq, {numbers}")
    return " UNION ALL ".join(rows)


# Views in order of dependency; {table} marks a driver table.
VIEWS = {
    # Grid cells of 14 hazards, 3 scenarios, 4 times and 2 models, some missing, some infinite.
    "cells_fx": f"""
SELECT {_HAZARD_CASE} AS hazard,
  CASE l_returnflag WHEN 'A' THEN 'RCP45' WHEN 'R' THEN 'RCP85' ELSE 'HISTORICAL' END AS scenario,
  CASE l_linenumber % 4 WHEN 0 THEN 'Cc' WHEN 1 THEN 'St' WHEN 2 THEN 'Mt' ELSE 'Lt' END AS time,
  CASE l_linestatus WHEN 'F' THEN 'M1' ELSE 'M2' END AS model,
  CASE l_linenumber % 3 WHEN 0 THEN 'mean' WHEN 1 THEN 'max' ELSE 'min' END AS statistic,
  CASE l_suppkey % 2 WHEN 0 THEN 'p5' ELSE 'p95' END AS metric,
  CAST(l_orderkey % 60 AS INT) AS lat_idx, CAST(FLOOR(l_partkey / 20) AS INT) AS lon_idx,
  CAST(l_orderkey % 60 AS INT) + CAST(0.5 AS DOUBLE) AS lat,
  CAST(FLOOR(l_partkey / 20) AS INT) + CAST(0.5 AS DOUBLE) AS lon,
  l_orderkey, l_linenumber,
  CASE WHEN l_discount = 0.0 THEN NULL ELSE l_quantity END AS value,
  CASE WHEN l_tax = 0.08 THEN CAST('Infinity' AS DOUBLE)
       WHEN l_discount = 0.0 THEN NULL ELSE FLOOR(l_extendedprice / 50) END AS rp
FROM {{lineitem}}""",
    # One value per hazard, scenario, time and cell.
    "hazard_grid_fx": """
SELECT hazard, scenario, time, lat_idx, lon_idx, lat, lon, MAX(value) AS value, MAX(rp) AS rp
FROM cells_fx GROUP BY hazard, scenario, time, lat_idx, lon_idx, lat, lon""",
    # One value per scenario, time and cell (sparse).
    "grid_fx": """
SELECT scenario, time, lat_idx, lon_idx, lat, lon, MAX(value) AS value, MAX(rp) AS rp
FROM cells_fx GROUP BY scenario, time, lat_idx, lon_idx, lat, lon""",
    # A static raster without scenario or time: protection, susceptibility or burnability 1–5.
    "static_fx": """
SELECT DISTINCT lat_idx, lon_idx,
  CASE WHEN (lat_idx + lon_idx) % 11 = 0 THEN NULL
       ELSE CAST(1 + (lat_idx * 3 + lon_idx) % 5 AS DOUBLE) END AS protection
FROM cells_fx""",
    # 0/1 coast mask on the cells' grid; no coast from row 36 on.
    "coast_fx": """
SELECT DISTINCT lat_idx, lon_idx, lat, lon,
  CAST(CASE WHEN lon_idx % 20 < 4 AND lat_idx < 36 THEN 1 ELSE 0 END AS DOUBLE) AS mask
FROM cells_fx""",
    # A coast raster on another, coarser and shifted grid.
    "coarse_coast_fx": """
SELECT CAST(FLOOR(lat_idx / 4) AS INT) AS lat_idx, CAST(FLOOR(lon_idx / 3) AS INT) AS lon_idx,
  FLOOR(lat_idx / 4) * 4 + CAST(1.75 AS DOUBLE) AS lat, FLOOR(lon_idx / 3) * 3 + CAST(2.0 AS DOUBLE) AS lon,
  MAX(CASE WHEN lon_idx % 20 < 4 AND lat_idx < 36 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS mask
FROM cells_fx
GROUP BY FLOOR(lat_idx / 4), FLOOR(lon_idx / 3)""",
    # Provinces (customers) in countries (nations).
    "zones_fx": """
SELECT n_name AS GID_0, CONCAT('Country of ', n_name) AS COUNTRY, CONCAT('Z', CAST(c_custkey AS VARCHAR(20))) AS GID_1,
  c_name AS NAME_1, c_mktsegment AS ENGTYPE_1, '' AS VARNAME_1, c_custkey AS zone_no
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "countries_fx": """
SELECT n_name AS GID_0, CONCAT('Country of ', n_name) AS COUNTRY FROM {nation}""",
    # Ring edges of the provinces: a concave outline for each, a hole in every fourth.
    "edges_fx": f"""
SELECT GID_1 AS gadm_id, GID_0 AS gid0, 0 AS part, ring, seq, cx + ax AS x1, cy + ay + af * k3 AS y1, cx + bx AS x2, cy + by_ + bf * k3 AS y2
FROM (SELECT GID_1, GID_0, zone_no / CAST(15.0 AS DOUBLE) AS cx, CAST(zone_no * 7 % 60 AS DOUBLE) AS cy,
    CAST(zone_no % 3 AS DOUBLE) AS k3, CASE WHEN zone_no % 4 = 0 THEN 'holed' ELSE 'plain' END AS shape FROM zones_fx) z
JOIN (SELECT shape, ring, seq, CAST(ax AS DOUBLE) AS ax, CAST(ay AS DOUBLE) AS ay, CAST(af AS DOUBLE) AS af,
    CAST(bx AS DOUBLE) AS bx, CAST(by_ AS DOUBLE) AS by_, CAST(bf AS DOUBLE) AS bf FROM ({_outline()}) t) v ON z.shape = v.shape""",
    # The same provinces with two more parts each, rings in all directions: an outline with a hole
    # that runs its way or the other, a part beside it in the same cells, a part inside the hole.
    "windings_fx": f"""
SELECT GID_1 AS gadm_id, GID_0 AS gid0, part, ring, seq,
  cx + CASE WHEN turned THEN bx ELSE ax END AS x1, cy + CASE WHEN turned THEN by_ ELSE ay END AS y1,
  cx + CASE WHEN turned THEN ax ELSE bx END AS x2, cy + CASE WHEN turned THEN ay ELSE by_ END AS y2
FROM (SELECT GID_1, GID_0, part, ring, seq, CAST(FLOOR(zone_no / 15) AS DOUBLE) AS cx, CAST(zone_no * 7 % 60 AS DOUBLE) AS cy,
    ax, ay, bx, by_, FLOOR(zone_no / CASE part * 2 + ring WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 8 END) % 2 = 1 AS turned
  FROM zones_fx JOIN ({_boxes()}) b ON zone_no % 2 = odd) t""",
    # Districts: two in each province.
    "districts_fx": """
SELECT GID_0, COUNTRY, GID_1, NAME_1, CONCAT(GID_1, '.', CAST(half AS VARCHAR(1))) AS GID_2, CONCAT(NAME_1, ' ', CAST(half AS VARCHAR(1))) AS NAME_2, zone_no, half
FROM zones_fx JOIN (SELECT 0 AS odd, 1 AS half UNION ALL SELECT 0, 2 UNION ALL SELECT 1, 1 UNION ALL SELECT 1, 2) h ON zone_no % 2 = odd""",
    "district_edges_fx": f"""
SELECT GID_2 AS gadm_id, GID_0 AS gid0, 0 AS part, 0 AS ring, seq,
  zone_no / CAST(15.0 AS DOUBLE) + ax AS x1, zone_no * 7 % 60 + ay AS y1, zone_no / CAST(15.0 AS DOUBLE) + bx AS x2, zone_no * 7 % 60 + by_ AS y2
FROM districts_fx d JOIN ({_quarters()}) q ON d.half = q.half AND zone_no % 2 = odd""",
    # Tidy statistics per hazard and province on three scales.
    "base_stats_fx": """
SELECT c.hazard, CONCAT('Z', CAST(o_custkey AS VARCHAR(20))) AS gadm_id, c.scenario, c.time,
  SUM(c.value) AS s, COUNT(c.value) AS n, MAX(c.value) AS m, MIN(c.value) AS lo
FROM cells_fx c JOIN {orders} ON c.l_orderkey = o_orderkey
GROUP BY c.hazard, o_custkey, c.scenario, c.time""",
    "stats_fx": " UNION ALL ".join(
        f"""
SELECT hazard, 1 AS gadm_level, gadm_id, '{scale}' AS scoring, scenario, time, ROUND(s / n / {div}, 6) AS score_mean,
  m / {div} AS score_max, ROUND((m - lo) / {div}, 6) AS score_stdev
FROM base_stats_fx WHERE n > 0"""
        for scale, div in (("5", 10), ("10", 5), ("100", "CAST(0.5 AS DOUBLE)"))
    ),
    "country_stats_fx": """
SELECT hazard, 0 AS gadm_level, GID_0 AS gadm_id, '5' AS scoring, scenario, time,
  ROUND(SUM(s) / SUM(n) / 10, 6) AS score_mean, MAX(m) / 10 AS score_max
FROM base_stats_fx JOIN zones_fx ON gadm_id = GID_1 WHERE n > 0
GROUP BY hazard, GID_0, scenario, time""",
}

# Views with many rows for a zone: the file's few row groups are dealt first, so that no task makes the rows of all its zones.
GROWN = ("edges_fx", "windings_fx", "districts_fx", "district_edges_fx")

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def with_views(body: str, *views: str, names: dict[str, str] | None = None) -> str:
    """A query preceded by the views it needs, and the views they need."""
    needed = set(views)
    for name in reversed(VIEWS):
        if name in needed:
            needed |= {v for v in VIEWS if v in VIEWS[name]}
    ctes = [f"{name} AS ({text})" for name, text in VIEWS.items() if name in needed]
    sql = f"WITH {', '.join(ctes)}\n{body}" if ctes else body
    for table in TABLES:
        sql = sql.replace("{" + table + "}", (names or {}).get(table, table))
    return sql


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views over the Parquet tables of a scale factor."""
    paths = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    # Small splits: a scan that groups its rows holds the groups of a whole split.
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", parts)
    if name not in GROWN:
        return spark.sql(with_views(f"SELECT * FROM {name}", name, names=paths))
    zones = spark.read.parquet(f"{sf_dir}/customer.parquet").repartition(int(parts), "c_custkey")
    return spark.sql(with_views(f"SELECT * FROM {name}", name, names=paths | {"customer": "{customer}"}), customer=zones)


def raster(spark: SparkSession, sf_dir: str) -> GridSpec:
    """The cells' raster: 60 rows, one column per 20 parts (the count comes from file footers)."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").count()
    return GridSpec(lat0=0.5, dlat=1.0, n_lat=N_LAT, lon0=0.5, dlon=1.0, n_lon=max(parts // 20, 1))
