"""Clean, deduplicated business-directory tables from crawled pages, on Spark."""

__version__ = "0.1.0"
