"""Spark-native analytics engine for pixel time series, rasters and embeddings."""

__version__ = "0.1.0"
