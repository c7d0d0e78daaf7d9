"""All registered queries (importing this module registers them)."""

from dimforge.plans import load_queries, operator_queries, source_queries  # noqa: F401  (register their queries)
from dimforge.plans.catalog import QUERIES

__all__ = ["QUERIES"]
