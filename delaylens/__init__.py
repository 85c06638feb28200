"""delaylens: flight-delay analytics as Spark DataFrame jobs."""
