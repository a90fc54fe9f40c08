"""Spark-native Bronze/Silver pipelines: typed landing, quality contracts,
change-log replay into a Data Vault, and point-in-time (as-of) queries."""

__version__ = "0.1.0"
