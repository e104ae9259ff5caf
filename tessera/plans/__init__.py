"""Registered queries (one per inventory row) and their DuckDB oracles."""

from tessera.plans.queries import QUERIES, ROWS_ONLY
from tessera.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ROWS_ONLY", "ORACLE_SQL"]
