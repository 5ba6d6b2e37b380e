"""Airline on-time analytics as plain Spark DataFrame functions, in batch and in streaming."""
