"""Sensor lake and alerting on Spark DataFrames and Structured Streaming."""
