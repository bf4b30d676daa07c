"""Batch lakehouse operators as plain PySpark: DataFrames in, DataFrames out."""
