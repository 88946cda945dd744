"""Structured Streaming forms of the telemetry analyses."""
