"""Usage reporting and benchmark statistics as Spark DataFrame jobs."""
