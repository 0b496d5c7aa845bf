"""Named queries over the test tables and their SQL counterparts."""

from planact.catalog import (  # noqa: F401  (importing registers the queries)
    actual_queries,
    change_queries,
    expression_queries,
    feed_queries,
    history_queries,
    plan_queries,
    report_queries,
    stream_queries,
)
from planact.catalog.core import CATALOG, Entry, plain

__all__ = ["CATALOG", "Entry", "plain"]
