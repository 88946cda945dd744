"""Figures inside probe payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: round-trip time in a ping transcript.
_LATENCY = r"(?i)time[=<](\d+(?:\.\d+)?)\s*ms"


def ping_latency(transcript: Column) -> Column:
    """First round-trip time in milliseconds, null when no reply came."""
    return F.nullif(F.regexp_extract(transcript, _LATENCY, 1), F.lit("")).try_cast("double")


def ping_status(transcript: Column) -> Column:
    return F.when(transcript.rlike(_LATENCY), F.lit("ONLINE")).otherwise(F.lit("TIMEOUT"))


def running_containers(document: Column) -> Column:
    """Containers running according to the daemon's document.

    A document without the figure counts as 0; null means that the document is
    no JSON object or that its figure is no whole number.
    """
    parsed = F.try_parse_json(document)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    stated = F.try_variant_get(parsed, "$.ContainersRunning", "variant").isNotNull()
    return F.when(is_object & ~stated, F.lit(0)).when(
        is_object, F.try_variant_get(parsed, "$.ContainersRunning", "int")
    )
