"""Registered queries (one per operator of SURVEY section 2) and their SQL oracles."""

from aerolake.plans.catalog import QUERIES, register
from aerolake.plans import streams as _streams  # noqa: F401  (registers stream queries)
from aerolake.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL", "register"]
