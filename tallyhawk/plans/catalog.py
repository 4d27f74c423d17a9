"""All registered queries (importing the modules registers them)."""

from tallyhawk.plans import rule_queries, warehouse_queries  # noqa: F401
from tallyhawk.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
