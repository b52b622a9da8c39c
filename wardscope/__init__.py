"""Spark-native analytics for geolocated, timestamped incident tables."""
