"""Spark-native preparation of wide tables and price-regression modelling."""

__version__ = "0.1.0"
