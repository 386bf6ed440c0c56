"""Every operator as a query over the driver's tables, with its oracle."""

from foliant.registry import (  # noqa: F401
    cluster_queries,
    file_queries,
    metric_queries,
    model_queries,
    text_queries,
    vector_queries,
)
from foliant.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
