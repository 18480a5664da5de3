"""Named queries over the given tables, each with the SQL that checks it."""

from . import aggregates, joins, models, projections, reports, scalars, scans, windows  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
