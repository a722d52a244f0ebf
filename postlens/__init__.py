"""PySpark-native analytics over community posts."""
