"""Spark-native analytics over records, documents and survey data."""
