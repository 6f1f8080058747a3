"""Frame alignment, radiometric statistics and release validation as Spark jobs."""
