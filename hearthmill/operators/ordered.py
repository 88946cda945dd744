"""Ordered sums that stay spread out when one key holds most rows.

A plain window puts all rows of a key into one task. Here a key is cut into
slots by order-preserving level columns. Slot totals come from an ordinary
aggregation, are accumulated level by level, and enter each slot as a carry
row ahead of its own rows. Carry rows travel in the shuffle that brings the
slot's rows together, so nothing is joined and null keys need no care.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CARRY, _ROW = 0, 1


def _with_carries(rows: DataFrame, carries: DataFrame | None) -> DataFrame:
    marked = rows.withColumn("_kind", F.lit(_ROW))
    if carries is None:
        return marked
    return marked.unionByName(
        carries.withColumn("_kind", F.lit(_CARRY)), allowMissingColumns=True
    )


def _slot_carries(
    df: DataFrame, keys: list[str], levels: list[str], names: list[str]
) -> DataFrame:
    """Sum of everything before each slot, as one row per slot."""

    def total(rows: DataFrame, depth: int) -> DataFrame:
        return rows.groupBy(*keys, *levels[:depth]).agg(*[F.sum(n).alias(n) for n in names])

    finest = total(df, len(levels))
    carries = None
    for depth in range(1, len(levels) + 1):
        slots = finest if depth == len(levels) else total(finest, depth)
        before = (
            Window.partitionBy(*keys, *levels[: depth - 1])
            .orderBy("_kind", levels[depth - 1])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        accumulated = {n: F.coalesce(F.sum(n).over(before), F.lit(0)) for n in names}
        carries = (
            _with_carries(slots, carries).withColumns(accumulated).where(F.col("_kind") == _ROW)
        ).drop("_kind")
    return carries


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Running sums per key in the order (levels, order), row included.

    ``levels`` go from coarse to fine and cut a key into slots; the finest
    should hold what one task can sort. ``sums`` names the result columns.
    Rows that tie on (levels, order) are accumulated in an arbitrary sequence,
    so ``order`` should end in a unique column.
    """
    keys, levels, names = list(keys), list(levels), list(sums)
    measured = df.withColumns(dict(sums))
    in_slot = (
        Window.partitionBy(*keys, *levels)
        .orderBy("_kind", *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        _with_carries(measured, _slot_carries(measured, keys, levels, names))
        .withColumns({n: F.sum(n).over(in_slot) for n in names})
        .where(F.col("_kind") == _ROW)
        .drop("_kind")
    )
