"""Spark-native analytics over research-dataset metadata."""
