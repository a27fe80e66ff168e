"""mercato: Spark-native marketplace and time-series analytics.

Sub-packages
------------
sources    table loading, bound views (``tracking``/``demand``), file sources
sinks      table/parquet writers, idempotent upsert, star schema, quality report
functions  column-level scalar functions (text, url, calendar, formatting)
operators  DataFrame operators (relational, windows, stats, text, html, ml ...)
plans      the query registry consumed by ``__spark_entry__.py``
streaming  Structured Streaming jobs, each with a batch twin
"""

__version__ = "0.1.0"
