"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from salesflow.plans import batch_queries, model_queries, serving_queries, stream_queries

_MODULES = (batch_queries, stream_queries, serving_queries, model_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
