"""Every operator as a query over the given tables, with its SQL twin."""

from paperloom.catalog import (  # noqa: F401
    file_queries, keyed_queries, payload_queries, scalar_queries, view_queries,
)
from paperloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
