"""All checked queries."""

from threadline.plans import queries_changes, queries_graph, queries_lineage, queries_search, queries_tables  # noqa: F401
from threadline.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
