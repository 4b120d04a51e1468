"""A market-data analytics engine built from Spark DataFrames and Structured Streaming."""
