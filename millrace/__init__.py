"""Spark-native ingestion and data-quality toolkit."""
