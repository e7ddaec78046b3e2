"""Marketplace analytics as Spark DataFrame plans."""
