"""txmart — a Spark-native transaction mart: conform, clean, key, merge, load, check, report."""

__version__ = "0.1.0"
