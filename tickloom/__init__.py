"""Market-data quality, coverage and event analytics on PySpark."""
