"""Service due dates and ordinal priorities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ordinal scale.
PRIORITIES = ["Low", "Medium", "High"]


def service_due(services: DataFrame, asset: Sequence[str], date: str) -> DataFrame:
    """Last service per asset plus its median interval in days.

    An asset has one row per calendar day at most before any ordering. With
    one service only there is no interval and no due date.
    """
    days = services.select(*asset, F.to_date(date).alias("_day")).distinct()
    in_order = Window.partitionBy(*asset).orderBy("_day")
    interval = F.datediff("_day", F.lag("_day").over(in_order))
    return (
        days.withColumn("_interval", interval)
        .groupBy(*asset)
        .agg(
            F.max("_day").alias("last_service"),
            F.count("*").alias("n_services"),
            F.median("_interval").alias("median_interval"),
        )
        .withColumn("next_service_due", F.date_add("last_service", F.round("median_interval").cast("int")))
    )


def priority_rank(priority: Column, scale: Sequence[str] = PRIORITIES) -> Column:
    """Position on an ordinal scale from 1; null when not on it."""
    position = F.array_position(F.array(*[F.lit(step) for step in scale]), priority)
    return F.nullif(position, F.lit(0)).cast("int")


def at_least(priority: Column, level: str, scale: Sequence[str] = PRIORITIES) -> Column:
    return priority_rank(priority, scale) >= list(scale).index(level) + 1
