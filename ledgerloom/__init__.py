"""Spark-native analytics over public-record registries, workflow events and text corpora."""
