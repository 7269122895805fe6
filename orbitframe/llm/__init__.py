"""Spark-native text operators for training-data pipelines."""
