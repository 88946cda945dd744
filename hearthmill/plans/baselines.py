"""Typical values and the records far from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthmill.operators.medians import grouped_median, histogram
from hearthmill.sources.shared import settle

# Scale of the median deviation to a standard deviation, and the
# number of deviations that makes a record unusual.
MAD_SCALE = 1.4826
MAD_LIMIT = 3.0

MONEY = "decimal(18,2)"

# Ten decimals and eighteen digits before them: wide enough to add up any
# figure of a statement or probe exactly.
EXACT = "decimal(28,10)"


def exact(value: str | Column) -> Column:
    """A figure for exact sums; null beyond the range, infinite or not a number."""
    return (F.col(value) if isinstance(value, str) else value).try_cast(EXACT)


def baseline(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median as the main measure, mean and count beside it.

    Exact sums, which do not depend on the row order, and counts come with the
    histogram of the median, so the rows are read twice in all.
    """
    bins = histogram(
        df, keys, value, _sum=F.sum(exact(value)), _summed=F.count(exact(value)), _values=F.count(value)
    )
    middle = grouped_median(df, keys, value, bins=bins).select(
        F.struct(*keys).alias("_group"), F.col("median").cast("double").alias("median_value")
    )
    means = bins.groupBy("_group").agg(
        (F.sum("_sum").cast("double") / F.sum("_summed")).alias("mean_value"), F.sum("_values").alias("n_values")
    )
    return means.join(middle, "_group", "left").select(
        "_group.*", "median_value", "mean_value", "n_values"
    )


def deviation_limits(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median and median absolute deviation per group."""
    medians = settle(grouped_median(df, keys, value).drop("n_values"), "medians")
    centred = (
        df.select(F.struct(*keys).alias("_group"), F.col(value).alias("_value"))
        .join(medians.select(F.struct(*keys).alias("_group"), "median"), "_group")
        .select("_group.*", "median", F.abs(F.col("_value") - F.col("median")).alias("_deviation"))
    )
    return grouped_median(centred, [*keys, "median"], "_deviation", "mad").drop("n_values")


def anomalies(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows more than three scaled deviations from their group's median."""
    limits = settle(deviation_limits(df, keys, value), "deviations").select(
        F.struct(*keys).alias("_group"),
        F.col("median").cast("double").alias("median_value"),
        F.col("mad").cast("double").alias("mad_value"),
    )
    distance = F.abs(F.col(value).cast("double") - F.col("median_value"))
    return (
        df.withColumn("_group", F.struct(*keys))
        .join(limits, "_group")
        .where(distance > MAD_LIMIT * MAD_SCALE * F.col("mad_value"))
        .drop("_group")
    )
