"""Search-performance analytics as PySpark DataFrame jobs."""
