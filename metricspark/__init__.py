"""A PySpark-native metrics and catalog analytics library."""
