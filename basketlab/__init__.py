"""Market-basket analytics as Spark DataFrame jobs."""
