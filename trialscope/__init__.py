"""Experiment analytics as composable Spark DataFrame operators."""
