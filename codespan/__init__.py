"""Coding-project analytics expressed as Spark DataFrame operations."""
