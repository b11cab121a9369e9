"""Spatial table analytics as Spark DataFrame jobs."""
