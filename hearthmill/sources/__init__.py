"""Scans of raw files and the tables written for later steps."""
