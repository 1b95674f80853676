"""Named queries over the test tables, each with its SQL where SQL can say the same."""

from __future__ import annotations

from . import checks, features, measures, series, sheets
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "checks", "features", "measures", "series", "sheets"]
