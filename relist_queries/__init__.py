"""Queries over the test tables, one per operator, each with the SQL it must agree with."""

from relist_queries import accounting, extraction, functions, jobs, reconciliation, scans, sinks, streams  # noqa: F401
from relist_queries.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
