"""Facility-level measurement analytics as plain Spark DataFrame functions."""
