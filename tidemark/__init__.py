"""Trend and commerce analytics as Spark jobs."""
