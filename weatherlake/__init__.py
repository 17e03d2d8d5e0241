"""Weather and climate analytics on Spark DataFrames and Structured Streaming."""
