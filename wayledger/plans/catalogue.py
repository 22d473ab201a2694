"""All queries of the core and their SQL."""

from __future__ import annotations

from wayledger.plans import data_queries, event_logs, layer_queries, scope_queries, store_queries

QUERIES = {**layer_queries.QUERIES, **scope_queries.QUERIES, **event_logs.QUERIES, **data_queries.QUERIES, **store_queries.QUERIES}
SQL = {**layer_queries.SQL, **scope_queries.SQL, **event_logs.SQL, **data_queries.SQL, **store_queries.SQL}
