"""Operational records to checked, keyed and summarised tables, on Spark."""
