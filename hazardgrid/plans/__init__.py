"""Jobs composed of operators: score, aggregate, combine, and all three."""

from hazardgrid.plans.aggregate import aggregate_all, aggregate_hazard
from hazardgrid.plans.combine import combine
from hazardgrid.plans.full import aggregate_only, combine_only, full_run, score_only
from hazardgrid.plans.score import score_all, score_cf, score_hazard, score_ls, score_many, score_rf, score_standard, score_sub, score_wf

__all__ = [
    "aggregate_all",
    "aggregate_hazard",
    "aggregate_only",
    "combine",
    "combine_only",
    "full_run",
    "score_all",
    "score_cf",
    "score_hazard",
    "score_ls",
    "score_many",
    "score_only",
    "score_rf",
    "score_standard",
    "score_sub",
    "score_wf",
]
