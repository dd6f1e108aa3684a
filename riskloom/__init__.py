"""Polygenic-score analytics as Spark DataFrame jobs."""
