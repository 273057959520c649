"""All registered queries."""

from tidemark.workload import dimensions, edges, files, layers, learning, merging, relational, runs  # noqa: F401
from tidemark.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
