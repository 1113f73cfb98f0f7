"""All registered queries and their SQL."""

from __future__ import annotations

from checks import corpus_queries, corpus_sql, landing_queries, landing_sql, page_queries, page_sql, report_queries, report_sql, source_queries, source_sql


def queries() -> dict:
    return {**corpus_queries.QUERIES, **page_queries.QUERIES, **report_queries.QUERIES, **source_queries.QUERIES, **landing_queries.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**corpus_sql.SQL, **page_sql.SQL, **report_sql.SQL, **source_sql.SQL, **landing_sql.SQL}
