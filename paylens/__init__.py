"""Payment analytics on Spark: staging, enrichment, marts, reports, quality and ML."""

__version__ = "0.1.0"
