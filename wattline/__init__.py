"""Metered-service lakehouse analytics on plain PySpark DataFrames."""
