"""Sentiment analytics over comment tables and streams, as plain Spark DataFrame functions."""
