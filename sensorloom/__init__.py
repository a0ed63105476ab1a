"""Sensor time-series analytics as composable Spark DataFrame operators."""
