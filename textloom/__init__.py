"""Spark-native corpus analytics: every operator is a DataFrame-to-DataFrame function."""
