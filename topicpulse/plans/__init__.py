"""Composed data products: gold tables, the daily run and the report queries."""
