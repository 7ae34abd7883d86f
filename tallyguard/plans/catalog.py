"""All registered queries; importing a query module registers its queries."""

from . import flow_queries, history_queries, log_queries, split_queries, stream_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
