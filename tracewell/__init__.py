"""tracewell: threat-indicator feeds, matching and table sync as Spark DataFrame jobs."""
