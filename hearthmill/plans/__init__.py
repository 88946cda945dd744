"""Whole analyses and ingest jobs built from the operators."""
