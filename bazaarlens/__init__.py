"""Marketplace analytics as PySpark DataFrame operators."""
