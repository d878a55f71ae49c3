"""Evidence pipelines over filings and web pages, expressed as Spark DataFrame jobs."""
