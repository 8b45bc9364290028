"""Interval-metered consumption analytics as Spark DataFrame operators."""
