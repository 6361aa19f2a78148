"""Spark-native analytics over interval annotations."""

__version__ = "0.1.0"
