"""Scoring jobs: one function per hazard type, a dispatcher and the run over all hazards."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid.catalog import CATALOG, PROTECTION_FACTOR, SETTINGS, HazardSettings, thresholds
from hazardgrid.functions import composite, minmax_score, protect, threshold_score
from hazardgrid.operators.align import align, ensemble_mean, fill_current_climate
from hazardgrid.operators.gapfill import fill_gaps
from hazardgrid.operators.prepare import drop_singleton_dims, scale_values, select_metric
from hazardgrid.operators.scoring import bounds_of, fan_out, minmax_bounds, with_bounds
from hazardgrid.plans.concurrent import run_each
from hazardgrid.schema import CELL, GridSpec
from hazardgrid.sources.stage import stage
from hazardgrid.sources.writers import write_scored

DEFAULT_SCALES = ("5", "10")


def _split(scales: tuple[str, ...]) -> tuple[list[str], bool]:
    names = [str(s) for s in scales]
    if not names:
        raise ValueError("at least one scale is needed")
    return [s for s in names if s != "100"], "100" in names


def _scored(df: DataFrame, value: str, columns: dict, hundred: bool, ref: tuple[str | None, str | None], adjust=None) -> DataFrame:
    """Fan the threshold scores out, with the 0–100 score of ``value`` beside them if asked for."""
    adjust = adjust or (lambda score, scale: score)
    if hundred:
        df = with_bounds(df, minmax_bounds(df, value, *ref))
        columns = {**columns, "100": minmax_score(F.col(value), F.col("_lo"), F.col("_hi"))}
    return fan_out(df, {scale: adjust(score, scale) for scale, score in columns.items()})


def score_standard(
    cells: DataFrame, code: str, value: str, scales=DEFAULT_SCALES, settings: HazardSettings | None = None, catalog: dict = CATALOG
) -> DataFrame:
    """ER, CER, CS, HS, DR, HP, TC, TS, WS: choose the metric, scale the input, score it."""
    s = settings or SETTINGS[code]
    plain, hundred = _split(scales)
    df = scale_values(select_metric(cells, s.metric_select), value, s.scale_factor)
    df = drop_singleton_dims(df)
    columns = {k: threshold_score(F.col(value), *thresholds(code, k, catalog=catalog)) for k in plain}
    return _scored(df, value, columns, hundred, (s.ref_scenario, s.ref_time))


def score_many(cells: DataFrame, codes: tuple[str, ...], value: str, scales=DEFAULT_SCALES, catalog: dict = CATALOG) -> DataFrame:
    """``score_standard`` of several hazards that share a table, from one scan of it.

    The hazard's metric, factor and thresholds are picked by CASE expressions; the bounds of the
    0–100 scale take a second scan that leaves one row per hazard, scenario and time. Labels stay as
    they are (aggregation drops those with a single value), but a chosen metric's is NULL.
    """
    plain, hundred = _split(scales)

    def by_code(pick: Callable[[str], Column | None], other: Column) -> Column:
        arms = {code: pick(code) for code in codes}
        return reduce(lambda e, c: e if arms[c] is None else F.when(F.col("hazard") == c, arms[c]).otherwise(e), codes, other)

    df = cells.filter(F.col("hazard").isin(*codes))
    if "metric" in df.columns:
        chosen = by_code(lambda c: F.lit(SETTINGS[c].metric_select) if SETTINGS[c].metric_select else None, F.lit(None).cast("string"))
        df = df.filter(chosen.isNull() | (F.col("metric") == chosen)).withColumn("metric", F.when(chosen.isNull(), F.col("metric")))
    factor = by_code(lambda c: F.lit(float(SETTINGS[c].scale_factor)) if SETTINGS[c].scale_factor else None, F.lit(1.0))
    df = df.withColumn(value, F.col(value) * factor)
    missing = F.lit(None).cast("double")
    columns = {k: by_code(lambda c, k=k: threshold_score(F.col(value), *thresholds(c, k, catalog=catalog)).cast("double"), missing) for k in plain}
    if not hundred:
        return fan_out(df, columns)
    v = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    axes = [c for c in ("scenario", "time") if c in df.columns]
    slices = stage(df.groupBy("hazard", *axes).agg(F.min(v).alias("_min"), F.max(v).alias("_max")), "slices", reuse=False)
    refs: dict[tuple, list[str]] = {}
    for code in codes:
        refs.setdefault((SETTINGS[code].ref_scenario, SETTINGS[code].ref_time), []).append(code)
    bounds = reduce(DataFrame.unionByName, [bounds_of(slices.filter(F.col("hazard").isin(*group)), ["hazard"], *ref) for ref, group in refs.items()])
    columns["100"] = minmax_score(F.col(value), F.col("_lo"), F.col("_hi"))
    return fan_out(with_bounds(df, bounds), columns)


def score_sub(cells: DataFrame, value: str, scales=DEFAULT_SCALES, settings: HazardSettings | None = None, catalog: dict = CATALOG) -> DataFrame:
    """Subsidence: the input is doubled for the 10-point scale only."""
    s = settings or SETTINGS["SUB"]
    plain, hundred = _split(scales)
    columns = {
        k: threshold_score(F.col(value) * 2 if k == "10" else F.col(value), *thresholds("SUB", k, catalog=catalog))
        for k in plain
    }
    return _scored(cells, value, columns, hundred, (s.ref_scenario, s.ref_time))


def score_ls(
    ari: DataFrame,
    susceptibility: DataFrame,
    scales=DEFAULT_SCALES,
    ari_col: str = "ari",
    susceptibility_col: str = "susceptibility",
    settings: HazardSettings | None = None,
    catalog: dict = CATALOG,
) -> DataFrame:
    """Landslide: score(rainfall index) × score(susceptibility), scored again.

    The 0–100 scale stretches the product of the first threshold scale asked for, else of the
    5-point one.
    """
    s = settings or SETTINGS["LS"]
    plain, hundred = _split(scales)

    def product(scale: str):
        a = threshold_score(F.col(ari_col), *thresholds("LS", scale, threshold_type="thresholds_ari", catalog=catalog))
        b = threshold_score(
            F.col(susceptibility_col), *thresholds("LS", scale, threshold_type="thresholds_susceptibility", catalog=catalog)
        )
        return composite(a, b)

    base = plain[0] if plain else "5"
    both = align(ari, susceptibility)
    both = both.withColumns({f"composite_{k}": product(k) for k in dict.fromkeys([base, *plain])})
    columns = {
        k: threshold_score(
            F.col(f"composite_{k}"), *thresholds("LS", k, threshold_type="thresholds_final", catalog=catalog)
        )
        for k in plain
    }
    return _scored(both, f"composite_{base}", columns, hundred, (s.ref_scenario, s.ref_time))


def fire_composite(
    fwi: DataFrame, burnability: DataFrame, n_lat: int, n_lon: int, fwi_col: str = "fwi", burn_col: str = "burnability", limit: int = 30,
    grid: GridSpec | None = None,
) -> DataFrame:
    """Burnability × gap-filled fire weather, on the burnable footprint only."""
    filled = fill_gaps(fwi, fwi_col, n_lat, n_lon, limit, grid)
    footprint = burnability.filter(F.col(burn_col).isNotNull())
    return align(filled, footprint).withColumn("composite", composite(F.col(burn_col), F.col(fwi_col)))


def score_wf(
    fwi: DataFrame,
    burnability: DataFrame,
    n_lat: int,
    n_lon: int,
    scales=DEFAULT_SCALES,
    fwi_col: str = "fwi",
    burn_col: str = "burnability",
    settings: HazardSettings | None = None,
    catalog: dict = CATALOG,
    grid: GridSpec | None = None,
) -> DataFrame:
    """Wildfire: score the composite of burnability and fire weather.

    With ``grid`` the scores carry coordinates, as those of the other hazards do.
    """
    s = settings or SETTINGS["WF"]
    plain, hundred = _split(scales)
    df = fire_composite(fwi, burnability, n_lat, n_lon, fwi_col, burn_col, grid=grid)
    columns = {k: threshold_score(F.col("composite"), *thresholds("WF", k, catalog=catalog)) for k in plain}
    return _scored(df, "composite", columns, hundred, (s.ref_scenario, s.ref_time))


def _score_flood(
    code: str, inundation: DataFrame, protection: DataFrame, value: str, protection_col: str, scales, settings, catalog
) -> DataFrame:
    """Score return periods, then subtract the protection class; 0–100 bounds come first."""
    s = settings or SETTINGS[code]
    plain, hundred = _split(scales)
    bounds = minmax_bounds(inundation, value, s.ref_scenario, s.ref_time) if hundred else None
    columns = {k: threshold_score(F.col(value), *thresholds(code, k, catalog=catalog)) for k in plain}
    df = inundation
    if bounds is not None:
        df = with_bounds(df, bounds)
        columns["100"] = minmax_score(F.col(value), F.col("_lo"), F.col("_hi"))
    df = align(df, protection.select(*CELL, protection_col))
    return fan_out(df, {k: protect(c, F.col(protection_col), PROTECTION_FACTOR[k]) for k, c in columns.items()})


def score_rf(
    cells: DataFrame,
    protection: DataFrame,
    value: str = "return_period_0_5_m",
    protection_col: str = "flood_protection",
    scales=DEFAULT_SCALES,
    settings: HazardSettings | None = None,
    catalog: dict = CATALOG,
) -> DataFrame:
    """River flood: ensemble mean, current climate from the historical run, score, protect."""
    inundation = fill_current_climate(ensemble_mean(cells, value), labels=cells)
    return _score_flood("RF", inundation, protection, value, protection_col, scales, settings, catalog)


def score_cf(
    cells: DataFrame,
    protection: DataFrame,
    value: str = "return_period_0_5_m",
    protection_col: str = "flood_protection",
    scales=DEFAULT_SCALES,
    settings: HazardSettings | None = None,
    catalog: dict = CATALOG,
    current_from_historical: bool = False,
) -> DataFrame:
    """Coastal flood: as river flood, but the historical scenario stays unless asked otherwise."""
    inundation = ensemble_mean(cells, value)
    if current_from_historical:
        inundation = fill_current_climate(inundation, labels=cells)
    return _score_flood("CF", inundation, protection, value, protection_col, scales, settings, catalog)


def score_hazard(
    code: str,
    cells: DataFrame,
    static: DataFrame | None = None,
    value: str | None = None,
    static_col: str | None = None,
    scales=DEFAULT_SCALES,
    raster: tuple[int, int] | GridSpec | None = None,
    out: str | None = None,
    catalog: dict = CATALOG,
) -> DataFrame:
    """Score one hazard by its type; with ``out`` also upsert the scores there.

    ``static`` is the variable without scenario and time that the special hazards need:
    susceptibility, burnability or flood protection. ``raster`` is the grid, or (rows, columns), of
    wildfire.
    """
    if code not in SETTINGS:
        raise ValueError(f"unknown hazard {code!r}")
    s = SETTINGS[code]
    if s.kind.startswith("special_") and static is None:
        raise ValueError(f"{code} needs its static variable")
    if s.kind == "special_ls":
        scored = score_ls(cells, static, scales, value or "ari", static_col or "susceptibility", catalog=catalog)
    elif s.kind == "special_wf":
        if raster is None:
            raise ValueError("WF needs the raster size")
        grid = raster if isinstance(raster, GridSpec) else None
        size = (raster.n_lat, raster.n_lon) if grid else raster
        scored = score_wf(cells, static, *size, scales, value or "fwi", static_col or "burnability", catalog=catalog, grid=grid)
    elif s.kind in ("special_rf", "special_cf"):
        flood = score_rf if s.kind == "special_rf" else score_cf
        scored = flood(cells, static, value or s.variable, static_col or s.protection, scales, catalog=catalog)
    elif s.kind == "sub":
        scored = score_sub(cells, value or s.variable, scales, catalog=catalog)
    else:
        scored = score_standard(cells, code, value or s.variable, scales, catalog=catalog)
    if "hazard" not in scored.columns:
        scored = scored.select(F.lit(code).alias("hazard"), "*")
    if out is not None:
        write_scored(scored, out)
    return scored


def score_all(inputs: dict[str, Callable[[], dict]], scales=DEFAULT_SCALES, out: str | None = None) -> tuple[dict[str, DataFrame], dict[str, Exception]]:
    """Score every hazard named, some side by side; one that fails is logged and the rest go on.

    ``inputs`` maps a hazard code to a function that opens its sources, as keyword arguments of
    ``score_hazard``. Hazards are partitions of the table at ``out``, so their writes don't meet.
    """
    return run_each("scoring", {code: (lambda code=code, opener=opener: score_hazard(code, scales=scales, out=out, **opener())) for code, opener in inputs.items()})
