"""Spark-native analytics over append-only listing observations."""
