"""Probe queries rendered from events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthmill.functions import probes
from hearthmill.operators import outages, telemetry
from hearthmill.plans.baselines import MONEY, baseline
from hearthmill.queries.registry import query, table
from hearthmill.sources.shared import fresh_path
from hearthmill.sources.telemetry_json import explode_samples, read_sample_arrays


def ping_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ping output: errors got no reply, some replies exit with 2."""
    key, kind = F.col("event_id"), F.col("event_type")
    figure = F.format_string("%.2f", F.col("value"))
    reply = F.when(
        key % 2 == 0, F.concat(F.lit("64 bytes from 10.0.0.1: icmp_seq=1 ttl=64 time="), figure, F.lit(" ms\n"))
    ).otherwise(F.concat(F.lit("Reply: TIME<"), figure, F.lit("MS, then time=9999 ms")))
    silence = F.lit("From 10.0.0.9 icmp_seq=1 Destination Host Unreachable")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.when(kind == "error", 1).when((kind == "signup") & (key % 7 == 0), 2).otherwise(0).alias("exit_code"),
        F.when(kind == "error", silence).otherwise(reply).alias("raw_payload"),
    )


@query(
    """
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS latency_ms,
       CASE event_type WHEN 'error' THEN 'TIMEOUT' ELSE 'ONLINE' END AS status
FROM events
"""
)
def ping_parse(spark, sf_dir):
    """Round trip of round-trip times."""
    payload = F.col("raw_payload")
    return ping_transcripts(spark, sf_dir).select(
        "event_id", probes.ping_latency(payload).alias("latency_ms"), probes.ping_status(payload).alias("status")
    )


@query(
    """
SELECT event_id, 'router_ping' AS source_component, 'latency_ms' AS metric_name,
       value AS metric_value, 'ONLINE' AS status
FROM events WHERE event_type <> 'error' AND NOT (event_type = 'signup' AND event_id % 7 = 0)
"""
)
def ping_samples(spark, sf_dir):
    """Only an answered probe with exit code 0 is a sample."""
    return telemetry.ping_observations(ping_transcripts(spark, sf_dir)).select(
        "event_id", "source_component", "metric_name", "metric_value", "status"
    )


@query(
    """
SELECT event_id, 'active_containers' AS metric_name,
       CASE WHEN event_id % 5 = 0 THEN 0 ELSE json_extract(props, '$.k')::INTEGER END::DOUBLE AS metric_value,
       'HEALTHY' AS status
FROM events WHERE event_id % 11 <> 0
"""
)
def daemon_json_parse(spark, sf_dir):
    """Container counts of daemon documents; broken documents are left out."""
    key = F.col("event_id")
    document = F.when(key % 11 == 0, F.lit("{broken")).when(key % 5 == 0, F.col("props")).otherwise(
        F.replace("props", F.lit('"k"'), F.lit('"ContainersRunning"'))
    )
    documents = table(spark, sf_dir, "events").select("event_id", document.alias("raw_payload"))
    return telemetry.daemon_observations(documents).select(
        "event_id", "metric_name", "metric_value", "status"
    )


@query(
    """
SELECT event_id, date_trunc('second', ts) AS "timestamp",
       CASE event_type WHEN 'view' THEN 'docker_stats' ELSE 'router_ping' END AS source_component,
       CASE event_type WHEN 'view' THEN 'active_containers' ELSE 'latency_ms' END AS metric_name,
       CASE event_type WHEN 'view' THEN json_extract(props, '$.k')::INTEGER ELSE value END::DOUBLE AS metric_value,
       'ONLINE' AS status, NULL::VARCHAR AS error
FROM events WHERE event_type IN ('click', 'purchase', 'view')
UNION ALL
SELECT event_id, NULL, NULL, NULL, NULL, NULL,
       CASE WHEN event_type = 'error' THEN 'unknown telemetry_type disk_io'
            WHEN event_id % 2 = 0 THEN 'unreadable figure' ELSE 'payload is not text' END
FROM events WHERE event_type IN ('error', 'signup')
"""
)
def telemetry_project(spark, sf_dir):
    """Samples to observations or, with a reason, to the quarantine."""
    key, kind = F.col("event_id"), F.col("event_type")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    figure = F.format_string("%.2f", F.col("value"))
    containers = F.regexp_extract("props", r"(\d+)", 1)

    def sample(component: str, *fields) -> Column:
        parts = ['{"timestamp":"', stamp, '","target":"10.0.0.1","status":"ONLINE","telemetry_type":"', component, '"']
        return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in [*parts, *fields, "}"]])

    text_payload = ',"raw_payload":"64 bytes"'
    rendered = (
        F.when(kind == "click", sample("router_ping", ',"latency_ms":', figure, text_payload))
        .when(kind == "purchase", sample("router_ping", ',"latency_ms":" ', figure, '"', text_payload))
        .when(kind == "view", sample("docker_stats", ',"active_containers":', containers, text_payload))
        .when(kind == "error", sample("disk_io", text_payload))
        .when(key % 2 == 0, sample("docker_stats", ',"active_containers":"4.5"', text_payload))
        .otherwise(sample("docker_stats", ',"active_containers":4', ',"raw_payload":{"a":1}'))
    )
    samples = table(spark, sf_dir, "events").select("event_id", F.try_parse_json(rendered).alias("sample"))
    return telemetry.project_samples(samples).drop("raw_payload", "record")


@query(
    """
SELECT event_id, 0 AS "position", value, NULL::VARCHAR AS error FROM events WHERE event_id % 10 > 1
UNION ALL
SELECT event_id, 4, round(value + 1, 2), NULL FROM events WHERE event_id % 10 > 1
UNION ALL
SELECT event_id, NULL, NULL, CASE event_id % 10 WHEN 0 THEN 'root is not a list' ELSE 'not JSON' END
FROM events WHERE event_id % 10 <= 1
"""
)
def telemetry_json_scan(spark, sf_dir):
    """JSON arrays to objects; other elements are skipped."""
    key = F.col("event_id")
    first, second = F.format_string('{"v": %.2f}', F.col("value")), F.format_string('{"v": %.2f}', F.col("value") + 1)
    array = F.concat(F.lit("["), first, F.lit(', 7, "{not an object}", [1], '), second, F.lit("]"))
    document = F.when(key % 10 == 0, first).when(key % 10 == 1, "[{broken").otherwise(array)
    documents = table(spark, sf_dir, "events").select("event_id", document.alias("document"))
    return explode_samples(documents).select(
        "event_id", "position", F.try_variant_get("sample", "$.v", "double").alias("value"), "error"
    )


@query(
    """
SELECT event_id, (2 * (row_number() OVER (PARTITION BY ts::DATE ORDER BY ts, event_id) - 1))::INTEGER AS "position",
       value, event_type, NULL::VARCHAR AS error
FROM events
"""
)
def telemetry_array_scan(spark, sf_dir):
    """Array files, one per day, read by splits; texts hold brackets and quotes, every second element is no object."""
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    ordered = Window.partitionBy("day").orderBy("ts", "event_id")
    element = F.to_json(
        F.struct("event_id", F.format_string("%.2f", F.col("value")).alias("v"), F.struct(F.concat(F.lit('}"],{\\'), "event_type").alias("kind")).alias("deep"))
    )
    first, last = F.row_number().over(ordered) == 1, F.lead("ts").over(ordered).isNull()
    line = F.concat(F.when(first, "[").otherwise(',"}",'), element, F.when(last, "]").otherwise(""))
    folder = fresh_path(spark, "sample-arrays")
    lines = events.select("day", line.alias("value"), "ts", "event_id").repartition("day").sortWithinPartitions("day", "ts", "event_id")
    lines.select("day", "value").write.partitionBy("day").text(folder)
    cell = lambda path, kind: F.try_variant_get("sample", path, kind)
    return read_sample_arrays(spark, f"{folder}/day=*").select(
        cell("$.event_id", "bigint").alias("event_id"), "position", cell("$.v", "double").alias("value"),
        F.expr("substring(try_variant_get(sample, '$.deep.kind', 'string'), 7)").alias("event_type"), "error",
    )


@query(
    """
WITH live AS (
  SELECT user_id, ts::DATE AS day, value, event_type FROM events WHERE event_type <> 'error'
  QUALIFY row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) = 1),
fixture AS (
  SELECT user_id, value, event_type FROM events WHERE event_type = 'signup' AND user_id % 10 <> 0
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
expected AS (
  SELECT user_id, unnest(generate_series(min(ts::DATE), max(ts::DATE), INTERVAL 1 DAY))::DATE AS day
  FROM events GROUP BY user_id)
SELECT e.user_id, e.day, CASE WHEN l.user_id IS NULL THEN f.value ELSE l.value END AS metric_value,
       CASE WHEN l.user_id IS NULL THEN f.event_type ELSE l.event_type END AS status,
       CASE WHEN l.user_id IS NULL AND f.user_id IS NULL THEN NULL ELSE l.user_id IS NULL END AS from_fixture,
       CASE WHEN l.user_id IS NULL AND f.user_id IS NULL THEN 'no live sample and no fixture row' END AS error
FROM expected e LEFT JOIN live l ON e.user_id = l.user_id AND e.day = l.day
     LEFT JOIN fixture f ON e.user_id = f.user_id
"""
)
def telemetry_fallback(spark, sf_dir):
    """Every user is probed every day; silent probes take the fixture row."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", F.to_date("ts").alias("day"),
        F.col("value").alias("metric_value"), F.col("event_type").alias("status"),
    )
    spans = events.groupBy("user_id").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    expected = spans.select("user_id", F.explode(F.sequence("first", "last")).alias("day"))
    live = telemetry.first_per_key(
        events.where("status <> 'error'"), ["user_id", "day"], ["ts", "event_id"]
    ).select("user_id", "day", "metric_value", "status")
    fixture = events.where("status = 'signup' and user_id % 10 <> 0").drop("day", "ts")
    return telemetry.with_fallback(expected, live, fixture, ["user_id"], ["event_id"], run=["day"])


@query(
    """
SELECT event_type, date_trunc('day', ts) AS window_start, count(*) AS n_samples,
       count(*) FILTER (value < 100) AS n_good,
       count(*) FILTER (value < 100)::DOUBLE / count(*) AS uptime
FROM events GROUP BY 1, 2
"""
)
def uptime_by_type(spark, sf_dir):
    """Daily share of fast samples per component."""
    return outages.uptime(
        table(spark, sf_dir, "events"), ["event_type"], F.col("value") < 100, "ts", "1 day"
    )


@query(
    """
SELECT date_trunc('day', ts) AS window_start, count(*) AS n_samples,
       count(*) FILTER (event_type <> 'error') AS n_good,
       count(*) FILTER (event_type <> 'error')::DOUBLE / count(*) AS uptime
FROM events GROUP BY 1
"""
)
def uptime_daily(spark, sf_dir):
    """Daily share of samples that are no error."""
    return outages.uptime(
        table(spark, sf_dir, "events"), [], F.col("event_type") != "error", "ts", "1 day"
    )


@query(
    """
SELECT event_type, ts::DATE AS day, round(median(value), 4) AS median_value,
       sum(value::DECIMAL(18,2))::DOUBLE / count(value) AS mean_value, count(value) AS n_values
FROM events WHERE event_type <> 'error' GROUP BY 1, 2
"""
)
def latency_daily(spark, sf_dir):
    """Median and mean latency of good samples per component and day."""
    good = table(spark, sf_dir, "events").where("event_type <> 'error'")
    daily = good.select("event_type", F.to_date("ts").alias("day"), F.col("value").cast(MONEY).alias("value"))
    return baseline(daily, ["event_type", "day"], "value").withColumn(
        "median_value", F.round("median_value", 4)
    )


_SESSIONS_SQL = """
WITH bad AS (
  SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before
  FROM events WHERE event_type = 'error'),
marked AS (
  SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
         OVER (PARTITION BY user_id ORDER BY ts) AS session FROM bad)
SELECT user_id, min(ts) AS outage_start, max(ts) AS outage_end, count(*) AS n_bad
FROM marked GROUP BY user_id, session
"""


@query(_SESSIONS_SQL)
def outage_sessions(spark, sf_dir):
    """Errors of a user at most 30 minutes apart."""
    bad = table(spark, sf_dir, "events").where("event_type = 'error'")
    return outages.outage_sessions(bad, ["user_id"], "ts")


@query(
    """
WITH counted AS (
  SELECT user_id, ts, event_type,
         sum((event_type <> 'error')::INTEGER) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS UNBOUNDED PRECEDING) AS good_before FROM events)
SELECT user_id, min(ts) AS outage_start, max(ts) AS outage_end, count(*) AS n_bad
FROM counted WHERE event_type = 'error' GROUP BY user_id, good_before
"""
)
def outage_runs(spark, sf_dir):
    """Unbroken runs of errors per user."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return outages.outage_runs(events, ["user_id"], F.col("event_type") != "error", "ts", "event_id")
