"""Queries over the test tables, each with the SQL it must agree with."""

from wakeline_checks import (cleaning, clusters, general, geofences, kpis, sketches,  # noqa: F401
                             streams, tables)
from wakeline_checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
