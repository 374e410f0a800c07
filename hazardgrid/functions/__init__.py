"""Column-level scoring rules."""

from hazardgrid.functions.scoring import (
    composite,
    minmax_score,
    nonzero,
    protect,
    rescale_hundred,
    rescore_quantiles,
    round_stat,
    rp_weight,
    threshold_score,
)

__all__ = [
    "composite",
    "minmax_score",
    "nonzero",
    "protect",
    "rescale_hundred",
    "rescore_quantiles",
    "round_stat",
    "rp_weight",
    "threshold_score",
]
