"""Variant analytics as Spark DataFrame operators."""
