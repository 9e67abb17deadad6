"""tidemark: ledger-warehouse jobs expressed as Spark DataFrame / SQL plans.

Layout
------
sources/    readers for parquet tables, JSON folders, CSV seeds, calendars
functions/  column-level helpers (null handling, keys, text, base64, dates, JSON)
operators/  DataFrame -> DataFrame jobs (incremental, ledger, groups, pricing,
            star schema, data quality, relational helpers)
plans/      the registered queries over the driver tables, each with a DuckDB oracle
streaming/  Structured Streaming variants of the incremental jobs
"""

__all__ = ["session"]
