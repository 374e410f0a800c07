from __future__ import annotations

from math import inf

import pytest

from hazardgrid.catalog import CATALOG, SETTINGS, load_catalog, threshold_rows, threshold_table, thresholds
from hazardgrid.schema import HAZARDS


def test_fourteen_hazards():
    assert sorted(CATALOG) == sorted(SETTINGS) == sorted(HAZARDS)
    assert len(HAZARDS) == 14


def test_scale_names_are_equal():
    assert thresholds("HS", "5") == thresholds("HS", 5) == thresholds("HS", "5_point")


def test_top_scores():
    assert thresholds("HS", "5")[1][-1] == 5
    assert thresholds("HS", "10")[1][-1] == 10


def test_landslide_kinds_differ():
    kinds = [thresholds("LS", "5", threshold_type=k)[0] for k in ("thresholds_ari", "thresholds_susceptibility", "thresholds_final")]
    assert kinds[0] != kinds[1] != kinds[2]
    # Without a kind the first table that has the scale is taken.
    assert thresholds("LS", "5")[0] == kinds[0]


@pytest.mark.parametrize("args", [("XX", "5"), ("HS", "3"), ("HS", "5", "p99"), ("LS", "3", None, "thresholds_ari")])
def test_unknown_names(args):
    with pytest.raises(ValueError):
        thresholds(*args)


def test_yaml_catalogue(tmp_path):
    path = tmp_path / "scoring.yaml"
    path.write_text(
        "hazards:\n  AA:\n    metrics:\n      m:\n        unit: x\n        scoring:\n"
        "          5_point:\n            thresholds: [-Infinity, 1, Infinity]\n            scores: [0, 1]\n"
        "          10_point: [0, 1, 2]\n"
    )
    catalog = load_catalog(str(path))
    assert thresholds("AA", 5, catalog=catalog) == ([-inf, 1, inf], [0, 1])
    assert thresholds("AA", 10, catalog=catalog) == ([0, 1, 2], [1, 2])


def test_rows_cover_every_value(spark):
    rows = threshold_rows()
    assert len(rows) < 300
    tables = {}
    for hazard, metric, kind, scale, i, lo, hi, _ in rows:
        tables.setdefault((hazard, metric, kind, scale), []).append((i, lo, hi))
    for bins in tables.values():
        assert bins[0][1] == -inf and bins[-1][2] is None
        assert all(a[2] == b[1] for a, b in zip(bins, bins[1:], strict=False))
    assert threshold_table(spark).count() == len(rows)
