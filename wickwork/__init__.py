"""Market time-series analytics written as ordinary Spark DataFrame code."""
