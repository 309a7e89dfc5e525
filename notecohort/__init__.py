"""notecohort: cohort-scoped clinical-note processing as lazy Spark DataFrame plans.

Layout
------
sources/    readers and writers (CSV ids, recursive/glob/pruned/tolerant parquet, sinks)
functions/  column-expression builders (staging patterns, title case, evidence windows,
            response parsing, prompt rendering, context budget)
operators/  DataFrame -> DataFrame operators (cohort joins, note filters, findings,
            per-patient batching, inference hook, reports, timeline, row index)
plans/      fixtures over the driver test tables and the query registry
streaming/  incremental file-batch extraction with Structured Streaming
"""

__version__ = "0.1.0"
