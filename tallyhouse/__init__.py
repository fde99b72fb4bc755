"""Point-of-sale loading, enrichment and reporting as Spark DataFrame code."""
