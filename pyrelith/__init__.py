"""PySpark-native analytics over space-time point observations."""
