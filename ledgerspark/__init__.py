"""Spark-native engine for public financial-disclosure data."""
