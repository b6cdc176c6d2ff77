"""Market-tick analytics as Spark DataFrame operators, for batch and Structured Streaming."""
