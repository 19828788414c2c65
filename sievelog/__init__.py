"""Security-log dataset preparation as Spark DataFrame jobs."""
