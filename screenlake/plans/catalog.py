"""Importing this module registers every query."""

from __future__ import annotations

from screenlake.plans import (  # noqa: F401
    feature_queries,
    graph_queries,
    index_queries,
    metric_queries,
    model_queries,
    source_queries,
    text_queries,
)
from screenlake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
