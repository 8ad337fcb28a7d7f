"""All registered queries and their SQL."""

from __future__ import annotations

from . import learned, stored, tabular, textual  # noqa: F401  (importing registers the queries)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
