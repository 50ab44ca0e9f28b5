"""All queries of the fare-data operators, and their SQL."""

from __future__ import annotations

from quayside.plans import cdc_queries, report_queries, stream_queries, table_queries

PARTS = (cdc_queries, table_queries, report_queries, stream_queries)


def queries() -> dict:
    return {name: query for part in PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for part in PARTS for name, text in part.SQL.items()}
