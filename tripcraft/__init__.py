"""Spark-native trip analytics: cleaning, exploration, modelling, scoring and request-log summaries."""
