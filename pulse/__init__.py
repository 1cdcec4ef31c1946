"""pulse: release-popularity analytics as Spark DataFrame jobs."""
