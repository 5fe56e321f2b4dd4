"""Spark-first cohort analytics."""
