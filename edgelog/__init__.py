"""Access-log analytics for CDN edge logs, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
