"""lakeops: scalable Spark operators and jobs for layered record tables."""
