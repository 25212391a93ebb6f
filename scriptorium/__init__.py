"""Spark-native engine for hierarchically numbered document rows."""
