"""Query catalogue: importing the modules registers their queries."""

from tessera.queries import (agg_queries, join_queries, medallion_queries,  # noqa: F401
                             physical_queries, report_queries, stream_queries, table_queries,
                             window_queries)
from tessera.queries.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
