"""Probe results to observations, with a fallback per component."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthmill.functions import dates, probes, text
from hearthmill.schemas import OBSERVATION_COLUMNS

_WHOLE_NUMBER = r"^[+-]?\d+$"
_DECIMAL_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _field(name: str, kind: str = "string") -> Column:
    return F.try_variant_get("sample", f"$.{name}", kind)


def project_samples(samples: DataFrame) -> DataFrame:
    """``sample`` objects to observations; ``error`` says why one is unusable.

    An unknown type, a missing field, an unreadable time or figure or a payload
    that is not text makes a sample unusable; ``record`` then keeps it whole.
    """
    kept = [name for name in samples.columns if name not in ("sample", "error")]
    earlier = F.col("error") if "error" in samples.columns else F.lit(None).cast("string")
    component = F.col("_component")
    is_ping, is_daemon = component == "router_ping", component == "docker_stats"
    payload_type = F.schema_of_variant(_field("raw_payload", "variant"))
    readable = F.when(is_ping, F.col("_figure").rlike(_DECIMAL_NUMBER)).when(
        is_daemon, F.col("_figure").rlike(_WHOLE_NUMBER)
    )
    error = (
        F.when(F.col("_earlier").isNotNull(), F.col("_earlier"))
        .when(component.isNull(), "no telemetry_type")
        .when(~(is_ping | is_daemon), F.concat(F.lit("unknown telemetry_type "), component))
        .when(_field("timestamp").isNull() | _field("status").isNull(), "missing field")
        .when(_field("timestamp").try_cast("timestamp").isNull(), "unreadable timestamp")
        .when(~F.coalesce(readable, F.lit(False)), "unreadable figure")
        .when(F.coalesce(payload_type, F.lit("")) != "STRING", "payload is not text")
    )
    judged = (
        samples.select(*kept, "sample", earlier.alias("_earlier"), _field("telemetry_type").alias("_component"))
        .withColumn(
            "_figure",
            text.strip(
                F.when(is_ping, _field("latency_ms")).when(is_daemon, _field("active_containers"))
            ),
        )
        .withColumn("error", error)
    )

    def if_usable(value: Column) -> Column:
        return F.when(F.col("error").isNull(), value)

    return judged.select(
        *kept,
        if_usable(_field("timestamp").try_cast("timestamp")).alias("timestamp"),
        if_usable(component).alias("source_component"),
        if_usable(F.when(is_ping, "latency_ms").otherwise("active_containers")).alias("metric_name"),
        if_usable(F.col("_figure").try_cast("double")).alias("metric_value"),
        if_usable(_field("status")).alias("status"),
        if_usable(_field("raw_payload")).alias("raw_payload"),
        F.when(F.col("error").isNotNull(), F.to_json("sample")).alias("record"),
        "error",
    )


def ping_results(transcripts: DataFrame) -> DataFrame:
    """Every probe of ``(timestamp, exit_code, raw_payload)`` rows as an observation; an unanswered one has an ``error``."""
    payload = F.col("raw_payload")
    answered = (F.col("exit_code") == 0) & (probes.ping_status(payload) == "ONLINE")
    return transcripts.withColumns(
        {
            "source_component": F.lit("router_ping"),
            "metric_name": F.lit("latency_ms"),
            "metric_value": probes.ping_latency(payload),
            "status": probes.ping_status(payload),
            "error": F.when(~F.coalesce(answered, F.lit(False)), F.concat_ws(" ", F.lit("no answer, exit code"), F.col("exit_code").cast("string"))),
        }
    )


def ping_observations(transcripts: DataFrame) -> DataFrame:
    """Answered probes of ``(timestamp, exit_code, raw_payload)`` rows."""
    return ping_results(transcripts).where("error is null").drop("error")


def daemon_results(documents: DataFrame) -> DataFrame:
    """Every daemon document of ``(timestamp, raw_payload)`` rows; an unreadable one has an ``error``."""
    running = probes.running_containers(F.col("raw_payload")).cast("double")
    return documents.withColumns(
        {
            "source_component": F.lit("docker_stats"),
            "metric_name": F.lit("active_containers"),
            "metric_value": running,
            "status": F.lit("HEALTHY"),
            "error": F.when(running.isNull(), "unreadable daemon document"),
        }
    )


def daemon_observations(documents: DataFrame) -> DataFrame:
    """Readable daemon documents of ``(timestamp, raw_payload)`` rows."""
    return daemon_results(documents).where("error is null").drop("error")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key.

    Spark turns this form into a group limit that runs before the shuffle, so
    each task sends one row per key and no key is gathered.
    """
    in_order = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(in_order)).where("_row = 1").drop("_row")


def with_fallback(
    expected: DataFrame,
    live: DataFrame,
    fixture: DataFrame,
    component: Sequence[str],
    fixture_order: Sequence[str],
    run: Sequence[str] = (),
) -> DataFrame:
    """One observation per expected probe, or an ``error``.

    A probe takes its live sample of the same ``run``, else the first fixture
    row of its ``component``. ``live`` has one row per probe at most.
    """
    probe = [*run, *component]
    values = [name for name in live.columns if name not in probe]
    samples = live.select(*probe, F.struct(*values).alias("_live"))
    backup = first_per_key(fixture, component, fixture_order).select(
        *component, F.struct(*values).alias("_fixture")
    )
    sample = F.coalesce("_live", "_fixture")
    return (
        expected.join(samples, probe, "left")
        .join(backup, list(component), "left")
        .select(
            *expected.columns,
            *[sample[name].alias(name) for name in values],
            F.when(sample.isNotNull(), F.col("_live").isNull()).alias("from_fixture"),
            F.when(sample.isNull(), "no live sample and no fixture row").alias("error"),
        )
    )


def displayed(observations: DataFrame) -> DataFrame:
    """Observations with the timestamp in its text form."""
    return observations.withColumn("timestamp", dates.utc_text(F.col("timestamp"))).select(
        *OBSERVATION_COLUMNS
    )
