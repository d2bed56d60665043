"""Irrigation telemetry analytics on Spark DataFrames."""
