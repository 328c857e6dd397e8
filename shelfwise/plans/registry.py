"""All catalog queries and their SQL, by name."""

from __future__ import annotations

from shelfwise.plans import config_queries, queries, scan_queries, sql, state_queries

QUERIES = queries.QUERIES
ORACLE_SQL = sql.ORACLE_SQL | config_queries.SQL | state_queries.SQL | scan_queries.SQL
