"""tsforge: a Spark-native time-series ingest and data-quality engine."""

__version__ = "0.2.0"
