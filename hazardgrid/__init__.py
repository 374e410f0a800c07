"""Spark-native scoring, zonal statistics and combination of gridded climate hazards."""

from hazardgrid.schema import HAZARDS, GridSpec

__all__ = ["HAZARDS", "GridSpec"]
