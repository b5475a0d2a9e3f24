"""Spark-native engine for incremental page-to-record pipelines and training-data operations."""

__version__ = "0.1.0"
