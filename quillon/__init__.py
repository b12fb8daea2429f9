"""Quillon: a PySpark-native engine for evidence-graded entity records."""
