"""Exact grouped medians without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthmill.sources.shared import settle

_BINS_PER_UNIT = 1024
_LARGEST_LOG = 800.0
_PARTS = 1024
# Distinct values of a bin that one task may sort.
_SORTED_AT_ONCE = 50_000


def value_bin(value: Column) -> Column:
    """Order-preserving coarse bin, about 0.1 % wide at any magnitude."""
    size = F.least(F.log1p(F.abs(value.cast("double"))), F.lit(_LARGEST_LOG)) * _BINS_PER_UNIT
    return F.floor(F.when(value < 0, -size).otherwise(size)).cast("int")


def histogram(df: DataFrame, keys: Sequence[str], value: str, **totals: Column) -> DataFrame:
    """Rows per group and bin, combined before the shuffle, with further totals; a written table.

    Nulls have the null bin, which takes part in the totals only.
    """
    binned = df.select("*", F.struct(*keys).alias("_group"), value_bin(F.col(value)).alias("_bin"))
    sums = [total.alias(name) for name, total in totals.items()]
    return settle(binned.groupBy("_group", "_bin").agg(F.count("*").alias("_rows"), *sums), "histogram")


def _middle(bins: DataFrame, group: Sequence[str]) -> DataFrame:
    """The one or two bins of a group that hold the ranks _low and _high, and the rows before each."""
    in_order = Window.partitionBy(*group).orderBy("_bin")
    before = F.col("_before") + F.sum("_rows").over(in_order) - F.col("_rows")
    return bins.withColumn("_before", before).where("_before <= _high and _before + _rows > _low")


def _refined(counted: DataFrame) -> DataFrame:
    """``counted`` cut down to finer bins: equal parts of each bin's own range.

    A relative bin of a narrow band far from zero holds the whole band. Its
    parts are counted like bins; only those of the middle ranks go on.
    """
    place = ["_group", "_bin"]
    value = F.col("_value").cast("double")
    ranges = counted.groupBy(*place).agg(F.min(value).alias("_from"), F.max(value).alias("_to"))
    share = (value - F.col("_from")) / F.nullif(F.col("_to") - F.col("_from"), F.lit(0.0))
    part = F.coalesce(F.least(F.floor(share * _PARTS), F.lit(_PARTS - 1)), F.lit(0)).cast("int")
    parted = settle(counted.join(ranges, place).withColumn("_part", part).drop("_from", "_to"), "parted-values")
    ranks = ["_before", "_low", "_high", "_n"]
    parts = parted.groupBy(*place, "_part", *ranks).agg(F.sum("_copies").alias("_rows"))
    coarse = parts.select("_group", F.col("_bin").alias("_outer"), F.col("_part").alias("_bin"), *ranks, "_rows")
    middle = settle(_middle(coarse, ["_group", "_outer"]).drop("_rows", "_low", "_high", "_n"), "middle-parts")
    own = middle.select("_group", F.col("_outer").alias("_bin"), F.col("_bin").alias("_part"), "_before")
    kept = parted.drop("_before").join(own, [*place, "_part"])
    # The pair of places becomes the bin; what is left of a group lies in two parts at most.
    return kept.withColumn("_bin", F.xxhash64("_bin", "_part")).drop("_part")


def grouped_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "median", bins: DataFrame | None = None
) -> DataFrame:
    """``keys`` plus the interpolated median and ``n_values``; nulls skipped.

    First a histogram per group (``bins``, if it is at hand) finds the one or
    two bins that hold the middle ranks. Then only the rows of those bins are
    counted by value. While a bin has more values than one task should sort,
    its own range is cut into parts. Every group is exact, whatever its size.
    """
    bins = (histogram(df, keys, value) if bins is None else bins).where("_bin is not null")
    total = F.sum("_rows").over(Window.partitionBy("_group"))
    ranked_bins = bins.select(
        "_group", "_bin", "_rows", F.lit(0).cast("bigint").alias("_before"), total.alias("_n")
    ).withColumns({"_low": F.expr("(_n - 1) div 2"), "_high": F.expr("_n div 2")})
    middle = settle(_middle(ranked_bins, ["_group"]).drop("_rows"), "middle-bins")
    values = df.where(F.col(value).isNotNull()).select(
        F.struct(*keys).alias("_group"), F.col(value).alias("_value"), value_bin(F.col(value)).alias("_bin")
    )
    # The bin limits are a written table, so Spark broadcasts them if they are small.
    rows = values.join(middle, ["_group", "_bin"])
    counted = rows.groupBy("_group", "_bin", "_value", "_n", "_before", "_low", "_high").agg(
        F.count("*").alias("_copies")
    )
    counted = settle(counted.withColumn("_bin", F.col("_bin").cast("bigint")), "middle-values")
    largest = None
    while True:
        held = counted.groupBy("_group", "_bin").agg(F.count("*").alias("k")).agg(F.max("k")).first()[0] or 0
        # Values that differ beyond a double's digits stay together.
        if held <= _SORTED_AT_ONCE or held == largest:
            break
        largest, counted = held, settle(_refined(counted), "middle-values")
    in_bin = Window.partitionBy("_group", "_bin").orderBy("_value")
    ranked = (
        counted.withColumn("_end", F.col("_before") + F.sum("_copies").over(in_bin))
        .withColumn("_start", F.col("_end") - F.col("_copies"))
    )

    def at(rank: str) -> Column:
        held = (F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end"))
        return F.min(F.when(held, F.col("_value")))

    return (
        ranked.groupBy("_group")
        .agg(((at("_low") + at("_high")) / 2).alias(name), F.first("_n").alias("n_values"))
        .select("_group.*", name, "n_values")
    )
