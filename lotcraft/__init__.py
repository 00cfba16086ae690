"""Procurement analytics as Spark DataFrame operators."""
