"""Emerging-topic analytics over dated text, written as Spark DataFrame operators."""
