"""Receivables and field-service analytics as Spark DataFrame jobs.

Layout
------
functions/  column-level helpers (date arithmetic rules, null/zero guards, cleaning)
sources/    readers: driver tables, domain adapter views, raw JSON landing
operators/  reusable relational building blocks (latest-per-key, joins, sinks, staging)
plans/      marts, BI measures, quality and monitoring jobs (DataFrame in -> DataFrame out)
streaming/  Structured Streaming ingest, dedupe, upsert and quarantine
"""

__all__ = ["session"]
