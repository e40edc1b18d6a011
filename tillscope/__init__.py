"""Retail-transaction analytics as composable Spark DataFrame operators."""
