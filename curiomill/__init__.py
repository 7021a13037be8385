"""Spark-native analytics over snapshots of shopping and auction pages."""
