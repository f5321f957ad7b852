"""Spark-native log, stream and ETL analytics as DataFrame-to-DataFrame functions."""

__version__ = "0.1.0"
