"""Registered queries, each next to the SQL that must give the same rows."""

from stayglass.catalog.registry import QUERIES, SQL
from stayglass.catalog import (  # noqa: F401  registration on import
    job_queries,
    join_queries,
    model_queries,
    profile_queries,
    row_queries,
    scalar_queries,
    source_queries,
    stream_queries,
)

__all__ = ["QUERIES", "SQL"]
