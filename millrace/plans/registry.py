"""Queries over the shared tables, by name, each with the DuckDB SQL it must agree with."""

from __future__ import annotations

from millrace.plans import reward_queries, table_queries  # noqa: F401 - they add their queries
from millrace.plans.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
