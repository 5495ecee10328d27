"""Fielded text index and keyword search as Spark DataFrame jobs."""
