"""Daily listing-snapshot analytics on PySpark.

Raw product pages are landed as partitioned Parquet, deduplicated, enriched and
compared day by day to infer which listings sold.  Every operator takes and returns
DataFrames or Columns; nothing runs until the caller writes or collects a result,
except where a docstring says so.
"""
