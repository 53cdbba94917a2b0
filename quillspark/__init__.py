"""Spark-native book structuring, dialogue attribution and text-corpus operators."""

__version__ = "0.1.0"
