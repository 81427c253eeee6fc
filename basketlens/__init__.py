"""Behavioural customer analytics as Spark DataFrame operators."""
