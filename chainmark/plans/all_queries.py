"""Importing this module registers every query."""

from chainmark.plans import cleaning_queries, condition_queries, line_queries, meeting_queries, network_queries  # noqa: F401
from chainmark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
