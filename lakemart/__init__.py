"""lakemart: a Spark-native medallion retail analytics library.

Raw e-commerce files go through a layered lake (bronze -> silver -> gold star
schema), and the gold star answers KPI, trend, category, segment, funnel and
outlier queries. Every operator is a DataFrame -> DataFrame function; Spark plans
and runs all the work.

Sub-packages:
  sources    schemas, file I/O, ingestion, adapter for the driver tables
  functions  scalar column helpers and predicates
  operators  column normalising, lenient casts, dedup, surrogate keys, SCD-2,
             data-quality checks
  plans      silver tables, gold star, dashboard queries, summary marts
  streaming  incremental file loading and continuously refreshed aggregates
"""

from lakemart.params import Params

__all__ = ["Params"]
