"""Catalog, credit and vote analytics as Spark DataFrame operators."""
