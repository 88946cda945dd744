"""Streaming queries over events written as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthmill.queries.registry import query, table
from hearthmill.queries.telemetry import _SESSIONS_SQL
from hearthmill.sources.shared import fresh_path
from hearthmill.streaming import runs
from hearthmill.streaming import telemetry as streaming

_EVENTS = ["event_id", "ts", "user_id", "event_type", "value"]


def event_stream(spark: SparkSession, sf_dir: str, deliveries: int = 1) -> DataFrame:
    """Events as a JSON-lines folder; every error is sent twice.

    Several ``deliveries`` are equal stretches of time, written one after the
    other and read by batches of their own.
    """
    events = table(spark, sf_dir, "events").select(*_EVENTS)
    repeated = events.unionByName(events.where("event_type = 'error'"))
    folder = fresh_path(spark, "event-lines")
    since, until = events.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts")) + 1).first()
    at = F.floor((F.unix_micros("ts") - F.lit(since)) * deliveries / F.lit((until or 0) - (since or 0)))
    # As many files per delivery as cores; a batch takes the files of one delivery.
    files = spark.sparkContext.defaultParallelism
    for delivery in range(deliveries):
        part = repeated.where(at == delivery).repartition(files) if deliveries > 1 else repeated
        part.write.mode("append").option("timestampFormat", streaming.TIMESTAMP_FORMAT).json(folder)
    samples = streaming.read_sample_stream(spark, folder, events.schema, files if deliveries > 1 else None)
    return streaming.readable(samples, "ts")


@query(
    """
SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS n_samples,
       count(*) FILTER (value < 100) AS n_good,
       count(*) FILTER (value < 100)::DOUBLE / count(*) AS uptime
FROM events GROUP BY 1, 2
"""
)
def telemetry_stream(spark, sf_dir):
    """Hourly share of fast samples per component, duplicates removed."""
    samples = streaming.without_duplicates(event_stream(spark, sf_dir), ["event_id"], "ts")
    result = streaming.uptime_stream(samples, ["event_type"], F.col("value") < 100, "ts")
    return streaming.run_to_table(result, "complete", "uptime")[0]


@query(_SESSIONS_SQL)
def outage_stream(spark, sf_dir):
    """Errors of a user at most 30 minutes apart, as sessions of a stream."""
    # Good samples cannot change a session, so they take no part in the state.
    errors = event_stream(spark, sf_dir).where("event_type = 'error'")
    samples = streaming.without_duplicates(errors, ["event_id"], "ts")
    result = streaming.outage_stream(samples, ["user_id"], F.lit(False), "ts")
    return streaming.run_to_table(result, "complete", "outages")[0]


@query(
    """
WITH hourly AS (
  SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS n_samples,
         count(*) FILTER (event_type <> 'error') AS n_good, round(avg(value), 10) AS metric_value
  FROM events GROUP BY 1, 2),
closed AS (
  SELECT * FROM hourly
  WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 48 HOUR FROM events)),
grid AS (
  SELECT event_type, unnest(generate_series((SELECT min(window_start) FROM closed),
         (SELECT max(window_start) FROM closed), INTERVAL 1 HOUR)) AS window_start
  FROM (SELECT DISTINCT event_type FROM events)),
fixture AS (SELECT event_type, round(arg_min(value, event_id), 10) AS metric_value FROM events GROUP BY 1)
SELECT g.event_type, g.window_start, coalesce(n_samples, 0) AS n_samples, coalesce(n_good, 0) AS n_good,
       CASE WHEN n_samples IS NULL THEN f.metric_value ELSE c.metric_value END AS metric_value,
       CASE WHEN n_samples IS NULL OR g.event_type <> 'error' THEN 'ONLINE' ELSE 'TIMEOUT' END AS status,
       n_samples IS NULL AS from_fixture, NULL::VARCHAR AS error
FROM grid g JOIN fixture f ON g.event_type = f.event_type
     LEFT JOIN closed c ON g.event_type = c.event_type AND g.window_start = c.window_start
"""
)
def probe_stream_fallback(spark, sf_dir):
    """Closed hourly windows per component over several batches, absent probes from the fixture."""
    events = event_stream(spark, sf_dir, deliveries=2).select(
        "event_id", "ts", "event_type", "_arrival", F.col("value").alias("metric_value"),
        F.when(F.col("event_type") == "error", "TIMEOUT").otherwise("ONLINE").alias("status"),
    )
    samples = streaming.without_duplicates(events, ["event_id"], "ts")
    closed = streaming.probe_windows(samples, "event_type", F.col("status") == "ONLINE", "ts")
    fixture = (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(F.min_by("value", "event_id").alias("metric_value"))
        .withColumn("status", F.lit("ONLINE"))
    )
    return streaming.run_to_table(
        closed, "append", "probe-windows",
        lambda batch, reached: streaming.fill_closed_windows(
            batch, fixture.select("event_type"), fixture, "event_type", filled_to=reached
        ),
        reaches="window_start",
    )[0].withColumn("metric_value", F.round("metric_value", 10))


@query(
    """
WITH marked AS (
  SELECT event_type, ts, event_id, value < 100 AS good,
         sum((value < 100)::INTEGER) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n_before FROM events),
runs AS (
  SELECT event_type, n_before, min(ts) AS outage_start, max(ts) AS outage_end, count(*) AS n_bad
  FROM marked WHERE NOT good GROUP BY 1, 2),
closing AS (
  SELECT event_type, n_before - 1 AS n_before, date_trunc('hour', ts) + INTERVAL 1 HOUR AS closes FROM marked WHERE good)
SELECT event_type, outage_start, outage_end, n_bad FROM runs JOIN closing USING (event_type, n_before)
WHERE closes <= (SELECT max(ts) - INTERVAL 48 HOUR FROM events)
"""
)
def outage_runs_stream(spark, sf_dir):
    """Runs of slow samples of a component over several batches, ended by a fast one in a closed hour."""
    samples = streaming.without_duplicates(event_stream(spark, sf_dir, deliveries=2), ["event_id"], "ts")
    return runs.outage_runs_to_table(samples, ["event_type"], F.col("value") < 100, "ts", "event_id")[0]
