"""Spark-native reconciliation engine: sources, operators and query plans over DataFrames."""
