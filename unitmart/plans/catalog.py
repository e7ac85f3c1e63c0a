"""All registered queries (importing the modules registers them)."""

from __future__ import annotations

from . import ingest_queries, registry  # noqa: F401
from .oracle import ORACLE_SQL
from .registry import REGISTRY

QUERIES = REGISTRY

__all__ = ["QUERIES", "ORACLE_SQL"]
