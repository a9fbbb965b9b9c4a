"""Operators: functions from DataFrame to DataFrame, and spark.ml stages."""
