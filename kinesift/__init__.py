"""Spark-native curation of multimodal time-series corpora."""

__version__ = "0.1.0"
