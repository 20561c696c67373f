"""Layered data quality and sales analytics as plain PySpark DataFrame work."""
