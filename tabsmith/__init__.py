"""tabsmith: Spark-native preparation, classification and audit of dirty tabular data.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, aggregates, windows and joins; fitted operators return their
statistics as (one-row or per-group) DataFrames that are broadcast-joined back.
"""

__version__ = "0.1.0"
