"""Registered queries over the given tables, each with its SQL twin.

A query marked as a round trip renders a typed column as messy text and parses
it back; its SQL reads the typed column, so the two share no parsing.
"""

from hearthmill.queries import analytics, documents, ledger, quality, streams, telemetry
from hearthmill.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analytics", "documents", "ledger", "quality", "streams", "telemetry"]
