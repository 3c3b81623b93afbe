"""Spark-native data-quality engine: clean, validate, split, measure."""
