"""Spark-native analytics for the structure of court judgments."""

__version__ = "0.1.0"
