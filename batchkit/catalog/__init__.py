"""Every query the package answers, each with the SQL text that must give the same rows."""

from __future__ import annotations

from batchkit.catalog import keyed, nested, orders, profile, retail, scores, sources  # noqa: F401
from batchkit.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
