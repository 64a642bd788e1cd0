"""Spark-native analytics over places, web pages and text corpora."""
