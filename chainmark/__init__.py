"""Condition analytics for linear assets, written as Spark DataFrame operators."""
