"""Layered clickstream and order warehouse on PySpark DataFrames and Structured Streaming."""
