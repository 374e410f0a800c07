"""Threshold catalogue, per-hazard settings, return-period weights and quantile bins."""

from __future__ import annotations

from dataclasses import dataclass
from math import inf

from pyspark.sql import DataFrame, SparkSession

from hazardgrid.schema import THRESHOLDS

# ---------------------------------------------------------------------------
# Thresholds and scores per hazard and scale.
# ---------------------------------------------------------------------------
_ONE_TO_FIVE = [1, 2, 3, 4, 5]
_ONE_TO_TEN = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
_ZERO_TO_FIVE = [0, 1, 2, 3, 4, 5]
_ZERO_TO_TEN = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
_RARE_TO_FREQUENT_5 = [1, 2, 3, 4, 5, 0]
_RARE_TO_FREQUENT_10 = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 0]

_EROSION = {
    "5_point": {"thresholds": [0, 5, 10, 20, 50, inf], "scores": _ONE_TO_FIVE},
    "10_point": {"thresholds": [0, 2.5, 5, 7.5, 10, 15, 20, 35, 50, 75, inf], "scores": _ONE_TO_TEN},
}
_FLOOD = {
    "5_point": {"thresholds": [inf, 1000, 250, 50, 5, 1e-7, 0], "scores": _RARE_TO_FREQUENT_5},
    "10_point": {
        "thresholds": [inf, 1000, 500, 250, 100, 50, 25, 10, 5, 2, 1e-7, 0],
        "scores": _RARE_TO_FREQUENT_10,
    },
}
_WIND = {
    "5_point": {"thresholds": [inf, 1000, 250, 50, 10, 1e-7, 0], "scores": _RARE_TO_FREQUENT_5},
    "10_point": {
        "thresholds": [inf, 10000, 5000, 2500, 1000, 500, 250, 100, 50, 2, 1e-7, 0],
        "scores": _RARE_TO_FREQUENT_10,
    },
}
_COLD = {
    "5_point": {"thresholds": [inf, 9, 0, -13, -27, -40, -inf], "scores": _ZERO_TO_FIVE},
    "10_point": {
        "thresholds": [inf, 9, 4.5, 0, -6.5, -13, -20, -27, -33.5, -40, -50, -inf],
        "scores": _ZERO_TO_TEN,
    },
}
_HEAT = {
    "5_point": {"thresholds": [-inf, 9, 26, 32, 38, 46, inf], "scores": _ZERO_TO_FIVE},
    "10_point": {
        "thresholds": [-inf, 4.5, 9, 17.5, 26, 29, 32, 35, 38, 42, 46, 52, inf],
        "scores": _ZERO_TO_TEN,
    },
}
_DROUGHT = {
    "5_point": {"thresholds": [0, 1, 2, 4, 6, inf], "scores": _ONE_TO_FIVE},
    "10_point": {"thresholds": [0, 0.5, 1, 1.5, 2, 3, 4, 5, 6, 7, inf], "scores": _ONE_TO_TEN},
}
_PRECIPITATION = {
    "5_point": {"thresholds": [0, 15, 30, 45, 60, 100], "scores": _ONE_TO_FIVE},
    "10_point": {"thresholds": [0, 7.5, 15, 22.5, 30, 37.5, 45, 52.5, 60, 80, 100], "scores": _ONE_TO_TEN},
}
_LANDSLIDE_ARI = {
    "5_point": {"thresholds": [0, 5, 10, 15, 20, inf], "scores": [1, 2, 3, 4, 5, 6]},
    "10_point": {"thresholds": [0, 2.5, 5, 7.5, 10, 12.5, 15, 17.5, 20, 22.5, inf], "scores": _ONE_TO_TEN},
}
_CLASSES = {
    "5_point": {"thresholds": [1, 2, 3, 4, 5], "scores": _ONE_TO_FIVE},
    "10_point": {"thresholds": [1, 2, 3, 4, 5], "scores": [2, 4, 6, 8, 10]},
}
_LANDSLIDE_FINAL = {
    "5_point": {"thresholds": [0, 5, 10, 15, 20, 25], "scores": _ONE_TO_FIVE},
    "10_point": {"thresholds": [10, 20, 30, 40, 50, 60, 70, 80, 90, 100], "scores": _ONE_TO_TEN},
}
_FIRE = {
    "5_point": {"thresholds": [0, 1e-6, 5.2, 11.2, 21.3, 50, inf], "scores": _ZERO_TO_FIVE},
    "10_point": {
        "thresholds": [0, 1e-6, 2.6, 5.2, 8.2, 11.2, 16.25, 21.3, 35.65, 43, 50, inf],
        "scores": _ZERO_TO_TEN,
    },
}
_WATER = {
    "5_point": {"thresholds": [0, 0.2, 0.4, 0.6, 0.8, 1], "scores": _ONE_TO_FIVE},
    "10_point": {"thresholds": [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1], "scores": _ONE_TO_TEN},
}

CATALOG = {
    "ER": {"erosion": {"thresholds": _EROSION}},
    "CER": {"cropland_erosion": {"scoring": _EROSION}},
    "CF": {"inundation_depth": {"scoring": _FLOOD}},
    "RF": {"inundation_depth": {"scoring": _FLOOD}},
    "CS": {"p5": {"scoring": _COLD}},
    "HS": {"p95": {"scoring": _HEAT}},
    "DR": {"number_of_extreme_drought_events_per_decade": {"scoring": _DROUGHT}},
    "HP": {"percentage_of_annual-precipitation_from_extreme_events": {"scoring": _PRECIPITATION}},
    "LS": {
        "landslide_proxy": {
            "thresholds_ari": _LANDSLIDE_ARI,
            "thresholds_susceptibility": _CLASSES,
            "thresholds_final": _LANDSLIDE_FINAL,
        }
    },
    "SUB": {"subsidence_rate": {"scoring": _CLASSES}},
    "TC": {"windspeed": {"scoring": _WIND}},
    "TS": {"windspeed": {"scoring": _WIND}},
    "WF": {"p95": {"scoring": _FIRE}},
    "WS": {"availability_vs_demand": {"scoring": _WATER}},
}

# Representative weight (1 / return period) of each score.
RP_WEIGHTS = {
    "5": {1: 0.001, 2: 0.001333, 3: 0.005714, 4: 0.033333, 5: 0.4},
    "10": {
        1: 0.001, 2: 0.001333, 3: 0.002667, 4: 0.005714, 5: 0.013333,
        6: 0.026667, 7: 0.057143, 8: 0.133333, 9: 0.285714, 10: 1.0,
    },
}

# q20, q40, q60, q80 of the weighted risk; None until calibrated.
QUANTILE_BINS = {
    ("RF", 0, "5"): (0.0000788, 0.000287, 0.000853, 0.00291),
    ("RF", 1, "5"): (0.0000788, 0.000287, 0.000853, 0.00291),
    ("CF", 0, "5"): (0.017636, 0.035215, 0.070596, 0.137059),
    ("CF", 1, "5"): (0.011421, 0.023441, 0.054597, 0.133054),
    ("RF", 0, "10"): None,
    ("RF", 1, "10"): None,
    ("CF", 0, "10"): None,
    ("CF", 1, "10"): None,
}

# Points subtracted per protection class on each scale.
PROTECTION_FACTOR = {"5": 1, "10": 2, "100": 20}


@dataclass(frozen=True)
class HazardSettings:
    """How one hazard is prepared and scored."""

    kind: str
    variable: str | None = None
    metric_select: str | None = None
    scale_factor: float | None = None
    protection: str | None = None
    ref_scenario: str | None = "RCP85"
    ref_time: str | None = None


# The settings of the 14 hazards.
SETTINGS = {
    "ER": HazardSettings("standard", "soil_erosion"),
    "CER": HazardSettings("standard", "cropland_erosion"),
    "CF": HazardSettings("special_cf", "return_period_0_5_m", protection="flood_protection"),
    "RF": HazardSettings("special_rf", "return_period_0_5_m", protection="flood_protection"),
    "CS": HazardSettings("standard", "utci", metric_select="p5"),
    "HS": HazardSettings("standard", "utci"),
    "DR": HazardSettings("standard", "drought_events_per_decade"),
    "HP": HazardSettings("standard", "extremes", metric_select="p95", scale_factor=100.0),
    "LS": HazardSettings("special_ls"),
    "SUB": HazardSettings("sub", "subsidence"),
    "TC": HazardSettings("standard", "return_period_windspeed_50_m_s", ref_time="St"),
    "TS": HazardSettings("standard", "return_period_windspeed_18_m_s", ref_time="St"),
    "WF": HazardSettings("special_wf"),
    "WS": HazardSettings("standard", "availabilityvsdemand"),
}


def scale_key(scale: str | int) -> str:
    """``5``, ``'5'`` and ``'5_point'`` all name the same table."""
    text = str(scale)
    return text if text.endswith("_point") else f"{text}_point"


def _with_infinities(node):
    if isinstance(node, dict):
        return {k: _with_infinities(v) for k, v in node.items()}
    if isinstance(node, list):
        return [_with_infinities(v) for v in node]
    if isinstance(node, str) and node.lower().lstrip("-") in ("infinity", ".inf", "inf"):
        return -inf if node.startswith("-") else inf
    return node


def load_catalog(path: str) -> dict:
    """Read a YAML threshold catalogue (``hazards: CODE: metrics: …``)."""
    import yaml  # only needed for catalogues kept in a file

    with open(path, encoding="utf-8") as f:
        hazards = _with_infinities(yaml.safe_load(f))["hazards"]
    return {code: entry["metrics"] for code, entry in hazards.items()}


def _as_table(entry) -> tuple[list[float], list[int]]:
    if isinstance(entry, list):  # bare thresholds: scores count up from 1
        return entry, list(range(1, len(entry)))
    return entry["thresholds"], entry["scores"]


def thresholds(
    hazard: str,
    scale: str | int,
    metric: str | None = None,
    threshold_type: str | None = None,
    catalog: dict = CATALOG,
) -> tuple[list[float], list[int]]:
    """Thresholds and scores of one hazard and scale; ValueError when there are none."""
    key = scale_key(scale)
    if hazard not in catalog:
        raise ValueError(f"unknown hazard {hazard!r}")
    metrics = catalog[hazard]
    name = metric if metric is not None else next(iter(metrics))
    if name not in metrics:
        raise ValueError(f"unknown metric {name!r} for {hazard}")
    tables = {k: v for k, v in metrics[name].items() if isinstance(v, dict)}
    for group in ("scoring", "thresholds"):
        if key in tables.get(group, {}):
            return _as_table(tables[group][key])
    if threshold_type in tables:
        candidates = [tables[threshold_type]]
    else:
        candidates = list(tables.values())
    for table in candidates:
        if key in table:
            return _as_table(table[key])
    raise ValueError(f"no {key} table for {hazard}.{name}")


def ascending(t: list[float], s: list[int]) -> tuple[list[float], list[int]]:
    """Threshold table in ascending order (return-period tables are written descending)."""
    return (t[::-1], s[::-1]) if t[0] > t[-1] else (list(t), list(s))


def threshold_rows(catalog: dict = CATALOG) -> list[tuple]:
    """One row per bin: values in [lo, hi) get ``score``; the end bins are open (hi NULL)."""
    rows = []
    for hazard, metrics in catalog.items():
        for metric, groups in metrics.items():
            for kind, table in groups.items():
                if not isinstance(table, dict):
                    continue
                for scale, entry in table.items():
                    if not scale.endswith("_point"):
                        continue
                    t, s = ascending(*_as_table(entry))
                    n = min(len(t), len(s))
                    for i in range(n):
                        lo = -inf if i == 0 else float(t[i])
                        hi = None if i == n - 1 else float(t[i + 1])
                        rows.append((hazard, metric, kind, scale[: -len("_point")], i, lo, hi, int(s[i])))
    return rows


def threshold_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The catalogue as a DataFrame: about 300 rows whatever the data size, so it broadcasts."""
    rows = threshold_rows(load_catalog(path) if path else CATALOG)
    return spark.createDataFrame(rows, THRESHOLDS)
