"""Star-schema warehouse builds, data-quality checks and reports on Spark."""
