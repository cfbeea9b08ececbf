"""Keyed time-series analytics on Spark: lake, cleaning, features, marts, anomaly scores."""
