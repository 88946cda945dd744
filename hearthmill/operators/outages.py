"""Outage intervals and availability of probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthmill.operators.ordered import running_sums


def outage_sessions(
    bad: DataFrame, component: Sequence[str], timestamp: str = "timestamp", gap_minutes: int = 30
) -> DataFrame:
    """Bad samples of a component joined while at most ``gap_minutes`` apart.

    Samples of one gap-long bin always belong together, so they are combined
    before the shuffle. A component then has one row per bin at most, however
    many samples it sent.
    """
    gap = gap_minutes * 60 * 1_000_000
    at = F.unix_micros(timestamp)
    bins = bad.groupBy(*component, F.floor(at / gap).alias("_bin")).agg(
        F.min(at).alias("_from"), F.max(at).alias("_to"), F.count("*").alias("_rows")
    )
    in_order = Window.partitionBy(*component).orderBy("_bin")
    starts = F.coalesce(F.col("_from") - F.lag("_to").over(in_order) > gap, F.lit(True))
    return (
        bins.withColumn("_starts", starts.cast("int"))
        .withColumn("_session", F.sum("_starts").over(in_order))
        .groupBy(*component, "_session")
        .agg(
            F.timestamp_micros(F.min("_from")).alias("outage_start"),
            F.timestamp_micros(F.max("_to")).alias("outage_end"),
            F.sum("_rows").alias("n_bad"),
        )
        .drop("_session")
    )


def outage_runs(
    samples: DataFrame, component: Sequence[str], good: Column, timestamp: str, tiebreak: str
) -> DataFrame:
    """Unbroken runs of bad samples: a good sample ends the run.

    Bad samples with the same number of good ones before them form a run. The
    number is accumulated per hour and second first, so neither a busy
    component nor a burst within an hour meets in one task.
    """
    marked = samples.withColumns(
        {
            "_good": F.coalesce(good, F.lit(False)),
            "_hour": F.date_trunc("hour", timestamp),
            "_second": F.date_trunc("second", timestamp),
        }
    )
    counted = running_sums(
        marked, component, ["_hour", "_second"], [timestamp, tiebreak],
        {"_good_before": F.col("_good").cast("int")},
    )
    return (
        counted.where(~F.col("_good"))
        .groupBy(*component, "_good_before")
        .agg(
            F.min(timestamp).alias("outage_start"),
            F.max(timestamp).alias("outage_end"),
            F.count("*").alias("n_bad"),
        )
        .drop("_good_before")
    )


def uptime(
    samples: DataFrame, component: Sequence[str], good: Column, timestamp: str, width: str
) -> DataFrame:
    """Share of good samples per component and window."""
    return (
        samples.groupBy(*component, F.window(timestamp, width).alias("_window"))
        .agg(F.count("*").alias("n_samples"), F.count_if(good).alias("n_good"))
        .select(
            *component,
            F.col("_window.start").alias("window_start"),
            "n_samples",
            "n_good",
            (F.col("n_good") / F.col("n_samples")).alias("uptime"),
        )
    )
