"""Crop-production analytics on PySpark: DataFrame in, DataFrame out."""

__version__ = "0.1.0"
