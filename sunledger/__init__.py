"""Energy time-series analytics as Spark DataFrame functions."""
