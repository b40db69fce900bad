"""Collects every registered query."""

from reelpress.plans import (  # noqa: F401  (each registers its queries on import)
    article_queries,
    ratings_queries,
    table_queries,
)
from reelpress.plans.registry import CATALOG, Query

__all__ = ["CATALOG", "Query"]
