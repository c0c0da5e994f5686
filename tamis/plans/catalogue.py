"""All registered queries."""

from tamis.plans import layer_queries, offer_queries, quality_queries, store_queries  # noqa: F401
from tamis.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
