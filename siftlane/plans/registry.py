"""Queries by name, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from siftlane.plans.collected import ORACLE_SQL, QUERIES
from siftlane.plans import contacts, gating, merging, more, scoring, tables, whole  # noqa: F401  they register their queries

FLAGSHIP = "lead_pipeline"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
