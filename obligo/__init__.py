"""obligo: public-spending analytics as Spark DataFrame jobs."""
