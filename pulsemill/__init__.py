"""Telemetry analytics on Spark: tables and streams of points, distributions and spans."""
