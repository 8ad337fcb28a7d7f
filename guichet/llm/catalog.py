"""All registered corpus queries and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import blocks, decontaminate, kdtree, lines, logbilinear, mixture, packing, periods, resample, secrets, simhash, spread, urls  # noqa: F401  (importing registers the queries)
from .registry import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = ["ORACLES", "QUERIES"]
