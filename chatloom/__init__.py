"""Chat operations analytics as Spark DataFrame jobs."""
