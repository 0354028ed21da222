"""Daily price panels on PySpark: ingest, look up, allocate, trade, value."""
