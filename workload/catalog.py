"""All registered queries."""

from workload import (  # noqa: F401
    counter_queries,
    function_queries,
    panel_queries,
    quality_queries,
    source_queries,
    update_queries,
)
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
