"""Investment account performance data on Spark: ingest, returns, quality,
reconciliation, reporting and monitoring as DataFrame transformations."""
