"""Spark-native spatial fusion and evaluation analytics."""
