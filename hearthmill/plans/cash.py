"""Cash flow, balances, forecasts and trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthmill.functions.dates import month_index, month_start
from hearthmill.operators.ordered import running_sums
from hearthmill.plans.baselines import exact

_ROWS_PER_SLOT = 1 << 20


def monthly_flow(df: DataFrame, by: Sequence[str], date: str, amount: str) -> DataFrame:
    """Net flow, inflow, outflow and rows per ``by`` and month.

    ``n_left_out`` counts the rows whose amount is missing or too large to add.
    """
    value = exact(amount)
    return (
        df.groupBy(*by, month_start(F.col(date)).alias("month"))
        .agg(
            F.sum(value).alias("net_flow"),
            F.sum(F.when(value > 0, value).otherwise(0)).alias("inflow"),
            F.sum(F.when(value < 0, value).otherwise(0)).alias("outflow"),
            F.count("*").alias("n_rows"),
            F.count_if(value.isNull()).alias("n_left_out"),
        )
        .withColumns({n: F.col(n).cast("double") for n in ("net_flow", "inflow", "outflow")})
    )


def running_balance(
    df: DataFrame, account: Sequence[str], date: str, number: str, amount: str
) -> DataFrame:
    """Balance after each row, by date and then the unique ``number``."""
    slotted = df.withColumns(
        {"_day": F.to_date(date), "_block": F.floor(F.col(number) / _ROWS_PER_SLOT)}
    )
    return running_sums(
        slotted, account, ["_day", "_block"], [number], {"balance": exact(amount)}
    ).drop("_day", "_block")


def _months(by: Sequence[str], first: int, last: int):
    return Window.partitionBy(*by).orderBy("_month").rangeBetween(first, last)


def _middle(values: Column) -> Column:
    low = F.get(values, F.floor((F.size(values) - 1) / 2).cast("int"))
    high = F.get(values, F.floor(F.size(values) / 2).cast("int"))
    return (low + high) / 2


def forecast(monthly: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean and median of the three calendar months before each month.

    ``monthly`` has one row per group and month; a month without rows is left
    out, not counted as zero.
    """
    before = _months(by, -3, -1)
    return (
        monthly.withColumn("_month", month_index(F.col("month")))
        .withColumns(
            {
                "months_used": F.count(value).over(before),
                "forecast_mean": F.sum(exact(value)).over(before).cast("double")
                / F.nullif(F.count(exact(value)).over(before), F.lit(0)),
                # Three values at most, so a list per row is bounded.
                "_values": F.array_sort(F.collect_list(value).over(before)),
            }
        )
        .withColumn("forecast_median", _middle(F.col("_values")))
        .drop("_month", "_values")
    )


def trend(monthly: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Change against the month before and the same month a year before."""

    figure = exact(value)

    def change(months_back: int):
        earlier = F.max(figure).over(_months(by, -months_back, -months_back))
        return (figure - earlier).cast("double")

    return (
        monthly.withColumn("_month", month_index(F.col("month")))
        .withColumns({"change_mom": change(1), "change_yoy": change(12)})
        .drop("_month")
    )
