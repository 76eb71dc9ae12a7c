"""Named queries with the SQL they are checked against."""
from panelflume.registry.base import QUERIES
from panelflume.registry import (allocation_queries, causal_queries, forecast_queries, model_queries, panel_queries,  # noqa: F401
                                 serving_queries)

__all__ = ["QUERIES"]
