"""Registered queries over the given tables and their SQL counterparts."""

from __future__ import annotations

from panelflow.plans import (  # noqa: F401  (registration)
    model_queries,
    panel_queries,
    source_queries,
    text_queries,
)
from panelflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
