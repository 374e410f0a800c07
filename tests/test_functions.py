from __future__ import annotations

from math import inf, nan

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardgrid.catalog import thresholds
from hazardgrid.functions import (
    minmax_score,
    protect,
    rescale_hundred,
    rescore_quantiles,
    round_stat,
    rp_weight,
    threshold_score,
)

V = None  # the column under test; columns need a running session


@pytest.fixture(autouse=True, scope="module")
def _column(spark):
    global V
    V = F.col("v")


TABLES = [
    thresholds("HS", "10"),
    thresholds("CF", "5"),
    thresholds("CS", "5"),
    thresholds("LS", "5", threshold_type="thresholds_ari"),
    thresholds("LS", "10", threshold_type="thresholds_final"),
    thresholds("SUB", "10"),
]


def by_counting(x, t, s):
    """Score of the last threshold that does not exceed the value; below all of them, of the least."""
    if x is None or x != x:
        return None
    if t[0] > t[-1]:
        t, s = list(reversed(t)), list(reversed(s))
    if x == inf:  # the table may end in a score that nothing else reaches
        return s[-1]
    passed = sum(threshold <= x for threshold in t)
    return s[min(max(passed, 1), len(s)) - 1]


def test_rising_thresholds(column):
    assert column(threshold_score(V, [2, 4, 8, 16], [10, 20, 30, 40]), [1.5, 2.0, 7.9, 8.0, 1e6]) == [10, 10, 20, 30, 40]


def test_falling_thresholds(column):
    assert column(threshold_score(V, [1000, 100, 10], [1, 3, 7]), [5000.0, 999.0, 100.0, 3.0]) == [1, 3, 3, 7]


def test_missing_stays_missing(column):
    assert column(threshold_score(V, [-1, 1], [4, 9]), [nan, 0.0, None, 1.0]) == [None, 4, None, 9]


def test_infinite_values_take_the_end_scores(column):
    assert column(threshold_score(V, [7, 9], [2, 6]), [-inf, inf]) == [2, 6]
    assert column(threshold_score(V, [9, 7], [2, 6]), [-inf, inf]) == [6, 2]


def test_boundary_values(column):
    values = [0, 3.2, 5, 7.8, 10, 20, 25, 50, 100]
    scores = column(threshold_score(V, *thresholds("ER", "5")), [float(v) for v in values])
    assert scores == [1, 1, 2, 2, 3, 4, 4, 5, 5]


def test_sixth_landslide_score_only_for_infinity(column):
    t, s = thresholds("LS", "5", threshold_type="thresholds_ari")
    assert column(threshold_score(V, t, s), [19.9, 20.0, 1e12, inf]) == [4, 5, 5, 6]


def test_empty_table():
    with pytest.raises(ValueError):
        threshold_score(V, [], [])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.one_of(st.none(), st.floats(width=32), st.sampled_from([0.0, 1e-7, 5.0, 9.0, 46.0, -40.0])), min_size=1, max_size=60),
    table=st.sampled_from(TABLES),
)
def test_equals_counting(column, values, table):
    expected = [by_counting(v, *table) for v in values]
    assert column(threshold_score(V, *table), values) == expected


def test_minmax(column):
    lo, hi = F.lit(10.0), F.lit(20.0)
    assert column(minmax_score(V, lo, hi), [5.0, 10.0, 12.5, 30.0, None]) == [0, 0, 25, 100, None]


def test_minmax_without_bounds_is_zero_even_for_missing(column):
    none = F.lit(None).cast("double")
    assert column(minmax_score(V, none, F.lit(3.0)), [5.0, None]) == [0, 0]
    assert column(minmax_score(V, F.lit(3.0), F.lit(3.0)), [5.0, None]) == [0, 0]


def test_minmax_infinite_bound(column):
    assert column(minmax_score(V, F.lit(0.0), F.lit(inf)), [5.0, inf]) == [0, None]


def test_protection(column):
    missing = F.lit(None).cast("double")
    assert column(protect(V, F.lit(2.0), 2), [10.0, 3.0, None]) == [6, 0, None]
    assert column(protect(V, missing, 1), [3.0]) == [None]


def test_weights(column):
    assert column(rp_weight(V, {1: 0.1, 2: 0.5}), [1.0, 2.0, 0.0, 1.5, None]) == [0.1, 0.5, None, None, None]


def test_quantile_classes_are_closed_above(column):
    values = [None, -1.0, 0.0, 0.1, 0.2, 0.25, 0.3, 0.4, 9.0]
    assert column(rescore_quantiles(V, 0.1, 0.2, 0.3, 0.4), values) == [0, 0, 0, 1, 2, 3, 3, 4, 5]


def test_rounding_is_half_to_even(column):
    assert column(round_stat(V, "5", "score_mean"), [0.5, 1.5, 2.5]) == [0, 2, 2]
    assert column(round_stat(V, "100", "score_max"), [0.125, 0.375]) == [0.12, 0.38]
    assert column(round_stat(V, "10", "score_stdev"), [0.00005]) == [0.0]


def test_rescale(column):
    lo, hi = F.lit(10.0), F.lit(20.0)
    assert column(rescale_hundred(V, lo, hi), [0.0, 10.0, 15.0, 25.0]) == [0, 0, 50, 100]
    assert column(rescale_hundred(V, F.lit(None).cast("double"), hi), [7.0]) == [7]
