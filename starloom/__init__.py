"""Operational tables -> immutable snapshots -> sales star schema -> warehouse, on Spark."""
