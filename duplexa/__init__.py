"""Spark-native analytics for small-interfering-RNA off-target discovery."""

__version__ = "0.1.0"
