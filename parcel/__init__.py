"""Parcel: Spark-native export, reconciliation and delivery of data files."""

__version__ = "0.1.0"
