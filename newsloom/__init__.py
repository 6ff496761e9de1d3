"""newsloom: article ingestion as Spark DataFrame jobs."""
