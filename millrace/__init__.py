"""Data jobs written on the PySpark DataFrame API."""
