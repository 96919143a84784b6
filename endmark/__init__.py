"""Spark-native analytics over read-end clusters, with a corpus subpackage beside it."""

__version__ = "0.1.0"
