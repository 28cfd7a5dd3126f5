"""Transaction ingestion, star schema and data quality as Spark DataFrame jobs."""
