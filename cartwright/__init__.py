"""Spark-native commerce warehouse: landing, staging, star schema, metrics and checks."""
