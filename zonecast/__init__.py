"""zonecast: ride-hailing analytics on Spark DataFrames, SQL and Structured Streaming.

Layout
------
functions/  column expressions (parsing, exact money arithmetic, surge rule, bins)
sources/    table scans and sinks, JSON decode, fixture views over the test tables
operators/  silver, gold, metrics, quality, rolling, tables (upsert / as-of /
            retention), history mapping, splits, features, model
streaming/  bronze / silver / live-view / scoring streams and their launcher
plans/      the registered queries and their DuckDB oracle SQL
"""

from zonecast.session import build_session, ensure_utc, work_dir

__all__ = ["build_session", "ensure_utc", "work_dir"]
