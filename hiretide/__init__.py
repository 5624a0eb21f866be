"""Job-posting streams and tables on Spark: parse, tag, count, store, query."""
