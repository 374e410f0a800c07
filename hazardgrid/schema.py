"""Names, label orders and table schemas shared by every module."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The label vocabulary of the data model.
HAZARDS = ("CER", "CF", "CS", "DR", "ER", "HP", "HS", "LS", "RF", "SUB", "TC", "TS", "WF", "WS")
SCENARIOS = ("HISTORICAL", "RCP45", "RCP85")
TIMES = ("Cc", "St", "Mt", "Lt")
META_COLUMNS = {
    0: ("GID_0", "COUNTRY"),
    1: ("GID_0", "COUNTRY", "GID_1", "NAME_1", "ENGTYPE_1", "VARNAME_1"),
    2: ("GID_0", "COUNTRY", "GID_1", "NAME_1", "GID_2", "NAME_2"),
}
ZONE_ID = {0: "GID_0", 1: "GID_1", 2: "GID_2"}
AREA = {0: "country", 1: "province", 2: "district"}
SCALE_FOLDER = {"5": "five", "10": "ten", "100": "hundred"}
STAT_COLUMNS = {"mean": "score_mean", "max": "score_max", "std": "score_stdev"}

SPATIAL = ("lat_idx", "lon_idx", "lat", "lon")
CELL = ("lat_idx", "lon_idx")
LABELS = ("hazard", "scoring", "scenario", "time", "statistic", "model", "metric")
ZONE = ("gadm_id", "gid0")

HAZARD_COLUMNS = tuple(f"{h}_{t}" for h in HAZARDS for t in TIMES)

HAZARD_STATS = T.StructType(
    [
        T.StructField("hazard", T.StringType()),
        T.StructField("gadm_level", T.IntegerType()),
        T.StructField("gadm_id", T.StringType()),
        T.StructField("gid0", T.StringType()),
        T.StructField("scoring", T.StringType()),
        T.StructField("scenario", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("score_mean", T.DoubleType()),
        T.StructField("score_max", T.DoubleType()),
        T.StructField("score_stdev", T.DoubleType()),
    ]
)

# Hazards differ in the labels they carry; read with this schema, absent ones are NULL.
SCORED = T.StructType(
    [
        T.StructField("scenario", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("statistic", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("lat_idx", T.IntegerType()),
        T.StructField("lon_idx", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("score", T.FloatType()),
        T.StructField("hazard", T.StringType()),
        T.StructField("scoring", T.StringType()),
    ]
)

THRESHOLDS = T.StructType(
    [
        T.StructField("hazard", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("threshold_type", T.StringType()),
        T.StructField("scale", T.StringType()),
        T.StructField("bin", T.IntegerType()),
        T.StructField("lo", T.DoubleType()),
        T.StructField("hi", T.DoubleType()),
        T.StructField("score", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class GridSpec:
    """A regular raster: centre of cell (0, 0), signed step and size per axis."""

    lat0: float
    dlat: float
    n_lat: int
    lon0: float
    dlon: float
    n_lon: int

    def x(self, lon: Column) -> Column:
        """Longitude in grid units; the centre of column c is c + 0.5."""
        return (lon - F.lit(self.lon0)) / F.lit(self.dlon) + F.lit(0.5)

    def y(self, lat: Column) -> Column:
        """Latitude in grid units; the centre of row r is r + 0.5."""
        return (lat - F.lit(self.lat0)) / F.lit(self.dlat) + F.lit(0.5)


def labels_of(df: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    """The label (non-spatial dimension) columns that a frame carries.

    The vocabulary's labels in their order, then any other text column: labels are text, variables
    are numbers. Zones aren't labels.
    """
    known = [c for c in LABELS if c in df.columns]
    other = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in (*LABELS, *ZONE)]
    return [c for c in (*known, *other) if c not in without]


def position(label: Column, order: tuple[str, ...]) -> Column:
    """Position of a label in its declared order; unknown labels come after the known ones."""
    expr = F.when(label == order[0], 0)
    for i, name in enumerate(order[1:], start=1):
        expr = expr.when(label == name, i)
    return expr.otherwise(len(order))
