"""Spark-native sales warehouse: clean, stage, dimension, fact, report."""
