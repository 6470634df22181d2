"""Spark-native corpus preparation and search."""
