"""A PySpark-native engine for layered data products and training-data preparation."""

__version__ = "0.1.0"
