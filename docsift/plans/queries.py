"""All registered queries."""

from docsift.plans import column_queries, container_queries, dedupe_queries, mail_queries, stored_queries, stream_queries  # noqa: F401
from docsift.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
