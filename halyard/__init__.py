"""Halyard: a PySpark-native medallion and training-data engine."""
